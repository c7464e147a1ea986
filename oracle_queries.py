"""DuckDB texts that say independently what each query in `__spark_entry__.py` returns.

They state each model in full, with every join, whatever the Spark side leaves out
of its plans. Run parameters (cut-offs, run times) are shared with the Spark side.
"""

from __future__ import annotations

from mercato.functions.scalars import NULL_KEY_PART
from mercato.plans.checks import CHECKS
from mercato.sources.driver_tables import duckdb_raw_tables
from mercato.sources.seeds import RATES

# Run parameters of the stateful and time-dependent queries.
UPSERT_CUTOFF = "2019-07-01 00:00:00"
RUN_1 = ("2019-07-01 02:00:00", "2019-07-01 02:10:00")
RUN_2 = ("2019-07-02 02:00:00", "2019-07-02 02:15:00")
RUN_BY = "nightly"
HISTORY_1 = "2018-01-01 00:00:00"
HISTORY_2 = "2018-02-01 12:30:00"
FUTURE_AFTER = "2020-06-01 00:00:00"
FRESH_AS_OF = "2021-08-04 08:00:00"


def _key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(cast({p} as varchar), '{NULL_KEY_PART}')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def _exact(amount: str) -> str:
    return f"cast({amount} as decimal(24,6))"


_STAGING = {
    "stg_customers": "select * replace (upper(customer_city) as customer_city) from raw_customers",
    "stg_orders": (
        "select order_id, customer_id, order_status, order_purchase_timestamp ordered_at,"
        " order_approved_at approved_at, order_delivered_carrier_date shipped_at,"
        " order_delivered_customer_date delivered_at,"
        " order_estimated_delivery_date estimated_delivery_at from raw_orders"
    ),
    "stg_order_items": (
        "select * exclude (shipping_limit_date), shipping_limit_date shipping_limit_at from raw_order_items"
    ),
    "stg_products": "from raw_products",
    "stg_payments": "from raw_payments",
    "stg_sellers": "select * replace (upper(seller_city) as seller_city) from raw_sellers",
    "stg_reviews": (
        "select * exclude (review_creation_date, review_answer_timestamp),"
        " review_creation_date review_created_at, review_answer_timestamp review_answered_at"
        " from raw_reviews"
    ),
    "stg_geolocation": "select * replace (upper(geolocation_city) as geolocation_city) from raw_geolocation",
    "stg_category_translation": "from raw_category_translation",
}

_PAYMENT_TYPE_SUMS = ", ".join(
    f"cast(coalesce(sum({_exact('payment_value')}) filter (payment_type = '{t}'), 0) as decimal(18,6))"
    f" {t}_value"
    for t in ("credit_card", "boleto", "voucher", "debit_card")
)


def _payments_summary(payments: str) -> str:
    return f"""
    select order_id,
      cast(sum({_exact("payment_value")}) as decimal(18,6)) total_payment_value,
      max(payment_installments) max_installments,
      count(*) filter (payment_installments > 1) installment_payment_count,
      {_PAYMENT_TYPE_SUMS},
      count(*) payment_record_count
    from {payments} group by all"""


def _delivery(orders: str, items: str) -> str:
    return f"""
    select o.order_id, order_status, ordered_at, shipped_at, delivered_at, estimated_delivery_at,
      shipping_deadline,
      cast(cast(delivered_at as date) - cast(estimated_delivery_at as date) as integer) delivery_delay_days,
      if(delivered_at is null, null, coalesce(delivered_at <= estimated_delivery_at, false))
        is_on_time_delivery,
      if(shipped_at is null, null, not coalesce(shipped_at <= shipping_deadline, false))
        is_seller_sla_breach,
      cast(cast(shipped_at as date) - cast(ordered_at as date) as integer) seller_processing_days
    from {orders} o left join
      (select order_id, min(shipping_limit_at) shipping_deadline from {items} group by all) using (order_id)
    """


def _orders_joined(orders: str, items: str) -> str:
    return f"""
    select i.order_id, i.order_item_id, o.customer_id, cu.customer_unique_id, o.order_status,
      o.ordered_at, o.approved_at, o.shipped_at, o.delivered_at, o.estimated_delivery_at,
      i.product_id, i.seller_id, i.price, i.freight_value,
      i.price + i.freight_value item_total_value, i.shipping_limit_at, p.product_category_name,
      ifnull(t.product_category_name_english, p.product_category_name) product_category_name_english,
      p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
      s.seller_city, s.seller_state
    from {items} i
      left join {orders} o using (order_id)
      left join stg_customers cu using (customer_id)
      left join stg_products p using (product_id)
      left join stg_sellers s using (seller_id)
      left join stg_category_translation t on t.product_category_name = p.product_category_name
    """


def _fct_orders(joined: str, payments: str, delivery: str) -> str:
    return f"""
    select {_key("j.order_id", "j.order_item_id")} order_item_key, j.order_id, j.order_item_id,
      c.customer_key, s.seller_key, p.product_key, d.date_key order_date_key,
      j.order_status, j.ordered_at, j.approved_at, j.shipped_at, j.delivered_at,
      j.estimated_delivery_at, j.price, j.freight_value, j.item_total_value,
      y.* exclude (order_id),
      v.delivery_delay_days, v.is_on_time_delivery, v.is_seller_sla_breach, v.seller_processing_days
    from {joined} j
      left join dim_customers c using (customer_unique_id)
      left join dim_sellers s using (seller_id)
      left join dim_products p using (product_id)
      left join dim_date d on d.date_day = cast(j.ordered_at as date)
      left join {payments} y on y.order_id = j.order_id
      left join {delivery} v on v.order_id = j.order_id
    """


_MODELS = {
    "order_payments_summary": _payments_summary("stg_payments"),
    "delivery_performance": _delivery("stg_orders", "stg_order_items"),
    "orders_joined": _orders_joined("stg_orders", "stg_order_items"),
    "dim_customers": f"""
    select {_key("customer_unique_id")} customer_key, * exclude (customer_id) from stg_customers
    qualify row_number() over (
      partition by customer_unique_id order by customer_id desc nulls first) = 1""",
    "dim_sellers": f"select {_key('seller_id')} seller_key, * from stg_sellers",
    "dim_products": f"""
    select {_key("product_id")} product_key, product_id, product_category_name,
      ifnull(product_category_name_english, product_category_name) product_category_name_english,
      product_weight_g, product_length_cm, product_height_cm, product_width_cm,
      product_length_cm * product_height_cm * product_width_cm product_volume_cm3
    from stg_products left join stg_category_translation using (product_category_name)""",
    "dim_date": f"""
    select {_key("date_day")} date_key, date_day,
      cast(year(date_day) as integer) "year",
      cast(quarter(date_day) as integer) quarter_number,
      cast(month(date_day) as integer) month_number,
      monthname(date_day) month_name,
      strftime(date_day, '%b') month_short,
      cast(weekofyear(date_day) as integer) week_of_year,
      cast(dayofweek(date_day) as integer) day_of_week,
      strftime(date_day, '%a') day_name_short,
      isodow(date_day) > 5 is_weekend,
      strftime(date_day, '%Y-%m') year_month,
      format('Q{{}}-{{}}', quarter(date_day), year(date_day)) quarter_label,
      strftime(date_day, '%d/%m/%Y') date_formatted
    from (select cast(unnest(generate_series(
      date '2016-01-01', date '2020-12-30', interval 1 day)) as date) date_day)""",
    "fct_orders": _fct_orders("orders_joined", "order_payments_summary", "delivery_performance")
    + " where j.ordered_at >= timestamp '2016-01-01'",
    "fct_reviews": f"""
    select {_key("review_id", "r.order_id")} review_key, review_id, r.order_id,
      date_key review_date_key, review_score,
      ifnull(review_score <= 2, false) is_negative_review,
      delivery_delay_days, is_on_time_delivery,
      ifnull(review_score <= 2, false) and ifnull(not is_on_time_delivery, false)
        is_late_delivery_negative_review,
      review_created_at, review_answered_at
    from stg_reviews r
      left join delivery_performance v on v.order_id = r.order_id
      left join dim_date on date_day = cast(review_created_at as date)""",
    "exchange_rates": "select * from (values "
    + ", ".join(f"('{c}', '{n}', cast({r} as double), date '{d}')" for c, n, r, d in RATES)
    + ") rates(currency_code, currency_name, rate_to_usd, effective_date)",
    # The first load of the upsert queries: earlier data, with other prices, and
    # with cancelled orders dated 40 days earlier.
    "early_orders": f"""
    select * replace (if(order_status = 'canceled', ordered_at - interval 40 day, ordered_at) as ordered_at)
    from stg_orders where ordered_at < timestamp '{UPSERT_CUTOFF}'""",
    "early_items": "select * replace (price + 1 as price) from stg_order_items",
    "early_joined": _orders_joined("early_orders", "early_items"),
    "early_delivery": _delivery("early_orders", "early_items"),
    "load_1": _fct_orders("early_joined", "order_payments_summary", "early_delivery")
    + " where j.ordered_at >= timestamp '2016-01-01'",
    "load_2": _fct_orders("orders_joined", "order_payments_summary", "delivery_performance")
    + " where j.ordered_at >= (select max(ordered_at) - interval 3 day from load_1)",
    "upserted": "from load_2 union all by name from load_1 anti join load_2 using (order_item_key)",
}

_SELLERS_1 = "(select * from raw_sellers where seller_state <> 'N3')"
_SELLERS_2 = """(select seller_id,
    case when seller_state in ('N1', 'N2') then upper(seller_city) else seller_city end seller_city,
    if(seller_state = 'N4', null, seller_state) seller_state,
    if(seller_state = 'N5', 'moved', seller_zip_code_prefix) seller_zip_code_prefix
  from raw_sellers where seller_state <> 'N6')"""


def _opened(alias: str, at: str, until: str = "null") -> str:
    return f"""{alias}.*, md5({alias}.seller_id || '|' || '{at}') scd_id,
      timestamp '{at}' updated_at, timestamp '{at}' valid_from, cast({until} as timestamp) valid_to"""


_CHANGED = "(a.seller_city is distinct from b.seller_city or a.seller_state is distinct from b.seller_state)"

_PER_ORDER = "(select distinct order_id, {0} from fct_orders)"


def _check_failures(check) -> str:
    column = check.column
    listed = ", ".join(repr(v) for v in check.values)
    conditions = {
        "not_null": f"{column} is null",
        "accepted_values": f"{column} not in ({listed})",
        "no_future_dates": f"{column} > timestamp '{FUTURE_AFTER}'",
        "positive_values": f"{column} < 0",
        "valid_scores": f"{column} is null or {column} not between 1 and 5",
    }
    if check.kind in conditions:
        return f"select count(*) from {check.model} where {conditions[check.kind]}"
    if check.kind == "unique":
        return (
            f"select count(*) from (select {column} from {check.model}"
            f" where {column} is not null group by all having count(*) > 1)"
        )
    return (
        f"select count(*) from {check.model} c where {column} is not null"
        f" and not exists (from {check.to} p where p.{check.field} = c.{column})"
    )


def _quality_suite() -> str:
    rows = [
        f"select '{c.name}' \"check\", '{c.model}' model, '{c.column}' \"column\", ({_check_failures(c)}) failures"
        for c in CHECKS
    ]
    return (
        "select *, if(failures = 0, 'pass', 'fail') status from (" + " union all ".join(rows) + ")"
    )


def _ratio(a: str, b: str) -> str:
    return f"cast({a} as double) / nullif({b}, 0)"


_PUBLISHED = ("dim_customers", "dim_sellers", "dim_products", "dim_date", "fct_orders", "fct_reviews")

# Columns of each written table and staging view, in order of their names.
_TABLE_COLUMNS = {
    "dim_customers": "customer_city customer_key customer_state customer_unique_id customer_zip_code_prefix",
    "dim_sellers": "seller_city seller_id seller_key seller_state seller_zip_code_prefix",
    "dim_products": "product_category_name product_category_name_english product_height_cm product_id product_key"
    " product_length_cm product_volume_cm3 product_weight_g product_width_cm",
    "dim_date": "date_day date_formatted date_key day_name_short day_of_week is_weekend month_name month_number"
    " month_short quarter_label quarter_number week_of_year year year_month",
    "fct_reviews": "delivery_delay_days is_late_delivery_negative_review is_negative_review is_on_time_delivery"
    " order_id review_answered_at review_created_at review_date_key review_id review_key review_score",
    "fct_orders": "approved_at boleto_value credit_card_value customer_key debit_card_value delivered_at"
    " delivery_delay_days estimated_delivery_at freight_value installment_payment_count is_on_time_delivery"
    " is_seller_sla_breach item_total_value max_installments order_date_key order_id order_item_id order_item_key"
    " order_status ordered_at payment_record_count price product_key seller_key seller_processing_days shipped_at"
    " total_payment_value voucher_value",
    "exchange_rates": "currency_code currency_name effective_date rate_to_usd",
    "stg_customers": "customer_city customer_id customer_state customer_unique_id customer_zip_code_prefix",
    "stg_orders": "approved_at customer_id delivered_at estimated_delivery_at order_id order_status ordered_at"
    " shipped_at",
    "stg_order_items": "freight_value order_id order_item_id price product_id seller_id shipping_limit_at",
    "stg_products": "product_category_name product_description_lenght product_height_cm product_id"
    " product_length_cm product_name_lenght product_photos_qty product_weight_g product_width_cm",
    "stg_payments": "order_id payment_installments payment_sequential payment_type payment_value",
    "stg_sellers": "seller_city seller_id seller_state seller_zip_code_prefix",
    "stg_reviews": "order_id review_answered_at review_comment_message review_comment_title review_created_at"
    " review_id review_score",
    "stg_geolocation": "geolocation_city geolocation_lat geolocation_lng geolocation_state"
    " geolocation_zip_code_prefix",
    "stg_category_translation": "product_category_name product_category_name_english",
}


def _row_hash(table: str) -> str:
    """32 bits from the text forms of a row's columns; numbers in hundredths, times in seconds."""

    def text(c: str) -> str:
        t = f'cast("{c}" as varchar)'
        return f"""coalesce(case when typeof("{c}") = 'DOUBLE'
            then cast(cast(round(try_cast({t} as double) * 100) as bigint) as varchar)
          when typeof("{c}") like 'DECIMAL%' then cast(cast(trunc(try_cast({t} as decimal(30,6)) * 100) as bigint) as varchar)
          when typeof("{c}") = 'TIMESTAMP' then cast(cast(epoch(try_cast({t} as timestamp)) as bigint) as varchar)
          else {t} end, '~')"""

    texts = ", ".join(map(text, _TABLE_COLUMNS[table].split()))
    return f"cast('0x' || substr(md5(concat_ws('|', {texts})), 1, 8) as bigint)"


_QUERIES = {
    **{name: f"from {name}" for name in _STAGING},
    **{
        name: f"from {name}"
        for name in (
            "order_payments_summary",
            "delivery_performance",
            "orders_joined",
            "dim_customers",
            "dim_sellers",
            "dim_products",
            "fct_orders",
            "fct_reviews",
        )
    },
    "dim_date": """
    select d.*, count(order_id) orders_placed from dim_date d
    left join stg_orders on cast(ordered_at as date) = date_day group by all""",
    "fanout_guard": f"""
    with wide as (
      select i.order_id, payment_record_count n, total_payment_value v
      from stg_order_items i left join order_payments_summary s on s.order_id = i.order_id)
    select count(*) joined_rows, cast(sum(ifnull(n, 1)) as decimal(38,0)) naive_rows,
      cast((select sum({_exact("payment_value")}) from stg_payments
        where order_id in (select order_id from stg_order_items)) as decimal(38,2)) payment_total,
      cast(sum(v) as decimal(38,2)) payment_total_over_items
    from wide""",
    "seed_exchange_rates": f"""
    select r.*, cast(t.gmv as decimal(38,2)) gmv, cast(t.gmv * cast(rate_to_usd as decimal(17,10)) as decimal(38,8)) gmv_usd
    from exchange_rates r left join (
      select 'BRL' currency_code, cast(sum({_exact("item_total_value")}) as decimal(20,2)) gmv
      from fct_orders) t using (currency_code)""",
    "published_tables": " union all ".join(
        f"select '{t}' table_name, count(*) row_count, cast(sum({_row_hash(t)}) as bigint) content_hash from {t}"
        for t in (*_PUBLISHED, "exchange_rates", *_STAGING)
    ),
    "incremental_upsert_orders": "from upserted",
    "incremental_upsert_large_batch": "from upserted",
    "orders_joined_bucketed": "from orders_joined",
    "schema_sync": """
    with late as (from order_payments_summary where max_installments >= 4)
    select * from late
    union all by name
    select * exclude (payment_record_count, voucher_value), cast(null as bigint) payment_record_count,
      cast(null as decimal(18,6)) voucher_value
    from order_payments_summary anti join late using (order_id)""",
    "audit_run_log": f"""
    select 'fct_orders' model_name, timestamp '{RUN_1[0]}' run_started_at,
      timestamp '{RUN_1[1]}' run_finished_at, (select count(*) from load_1) rows_affected, '{RUN_BY}' run_by,
      true in_order, false is_recent, false by_session_user
    union all
    select 'fct_orders', timestamp '{RUN_2[0]}', timestamp '{RUN_2[1]}',
      (select count(*) from upserted), '{RUN_BY}', true, false, false
    union all
    select 'fct_orders', null, null, (select count(*) from upserted), null, true, true, true""",
    "audit_log_replay": f"""
    select 'fct_orders' model_name, timestamp '{RUN_1[0]}' run_started_at,
      timestamp '{RUN_1[1]}' run_finished_at, (select count(*) from load_1) rows_affected, '{RUN_BY}' run_by,
      'feed/0' run_id, 2 versions
    union all
    select 'fct_orders', timestamp '{RUN_2[0]}', timestamp '{RUN_2[1]}',
      (select count(*) from upserted), '{RUN_BY}', 'feed/1', 2""",
    "scd2_sellers": f"""
    with a as (from {_SELLERS_1}), b as (from {_SELLERS_2})
    select {_opened("a", HISTORY_1)} from a left join b using (seller_id)
      where b.seller_id is null or not {_CHANGED}
    union all
    select {_opened("a", HISTORY_1, f"timestamp '{HISTORY_2}'")} from a join b using (seller_id)
      where {_CHANGED}
    union all
    select {_opened("b", HISTORY_2)} from b left join a using (seller_id)
      where a.seller_id is null or {_CHANGED}""",
    "fn_safe_divide": f"""
    select order_id, payment_record_count, installment_payment_count,
      {_ratio("payment_record_count", "installment_payment_count")} payments_per_installment
    from order_payments_summary""",
    "fn_cents_to_currency": """
    select order_id, order_item_id, price * 10 price_cents,
      cast(cast(price * 10 as decimal(38,0)) / 100 as decimal(38,2)) price_amount
    from stg_order_items""",
    "fn_surrogate_key": f"""
    select review_id, order_id, {_key("review_id", "order_id")} key_of_two,
      {_key("review_comment_title", "order_id")} key_with_null, {_key("review_score")} key_of_number
    from stg_reviews""",
    # Each order lies half an hour after a whole number of hours before or after now.
    "fn_current_timestamp_utc": """
    select order_status, count(*) filter (hour(ordered_at) < 12) past_orders,
      count(*) filter (hour(ordered_at) >= 12) future_orders
    from stg_orders group by all""",
    "dq_unique": """
    select review_id unique_field, count(*) n_records from stg_reviews
    where review_id is not null group by all having count(*) > 1""",
    "dq_not_null": "from stg_products where product_category_name is null",
    "dq_accepted_values": "from stg_reviews where review_score not in (1, 2, 3, 4, 5)",
    "dq_relationships": """
    from stg_order_items where order_id is not null and order_id not in (select order_id from stg_orders)""",
    "dq_no_future_dates": f"""
    select order_item_key, ordered_at from fct_orders where ordered_at > timestamp '{FUTURE_AFTER}'""",
    "dq_positive_values": "select order_item_key, freight_value from fct_orders where freight_value < 0",
    "dq_valid_review_scores": """
    from fct_reviews where review_score is null or review_score < 1 or review_score > 5""",
    "dq_freshness": f"""
    select *, epoch(as_of - max_loaded_at) / 3600 age_hours,
      case when age_hours > 48 then 'error' when age_hours > 24 then 'warn' else 'pass' end status
    from (select max(_loaded_at) max_loaded_at, timestamp '{FRESH_AS_OF}' as_of from raw_orders)""",
    "dq_suite": _quality_suite(),
    "kpi_gmv": f"""
    select cast(sum({_exact("item_total_value")}) as decimal(38,2)) gmv from fct_orders""",
    "kpi_aov": f"""
    select cast(sum({_exact("item_total_value")}) as decimal(38,2)) gmv,
      count(distinct order_id) order_count, {_ratio("gmv", "order_count")} aov from fct_orders""",
    "kpi_on_time_rate": f"""
    select count(*) filter (is_on_time_delivery) on_time_orders,
      count(is_on_time_delivery) delivered_orders, {_ratio("on_time_orders", "delivered_orders")} on_time_rate
    from {_PER_ORDER.format("is_on_time_delivery")}""",
    "kpi_avg_delay": f"""
    select avg(delivery_delay_days) avg_delay_days,
      (select avg(delivery_delay_days) from {_PER_ORDER.format("delivery_delay_days")})
        avg_delay_days_per_order
    from fct_orders""",
    "kpi_sla_breach_rate": f"""
    select count(*) filter (is_seller_sla_breach) breached_items,
      count(is_seller_sla_breach) shipped_items,
      {_ratio("breached_items", "shipped_items")} sla_breach_rate from fct_orders""",
    "kpi_installment_rate": f"""
    select cast(sum(installment_payment_count) as bigint) installment_payments,
      cast(sum(payment_record_count) as bigint) payments,
      {_ratio("installment_payments", "payments")} installment_rate
    from {_PER_ORDER.format("installment_payment_count, payment_record_count")}""",
    "kpi_avg_review": """
    select count(review_score) scored_reviews, avg(review_score) avg_review_score from fct_reviews""",
    "kpi_late_negative_rate": f"""
    select count(*) filter (is_late_delivery_negative_review) late_negative_reviews,
      count(*) filter (is_negative_review) negative_reviews,
      {_ratio("late_negative_reviews", "negative_reviews")} late_negative_rate from fct_reviews""",
    "kpi_repeat_customer_rate": f"""
    select count(*) filter (n > 1) repeat_customers, count(*) customers,
      {_ratio("repeat_customers", "customers")} repeat_customer_rate
    from (select customer_key, count(distinct order_id) n from fct_orders
      where customer_key is not null group by all)""",
    "kpi_top_categories": f"""
    select product_category_name_english, cast(sum({_exact("price")}) as decimal(38,2)) revenue
    from fct_orders left join dim_products using (product_key) group by all
    order by revenue desc, product_category_name_english nulls last limit 10""",
    "kpi_payment_mix": f"""
    select {", ".join(f"cast(sum({c}) as decimal(38,2)) {c}" for c in (
        "total_payment_value", "credit_card_value", "boleto_value", "voucher_value", "debit_card_value"))}
    from {_PER_ORDER.format(
        "total_payment_value, credit_card_value, boleto_value, voucher_value, debit_card_value")}""",
    "kpi_gmv_usd": f"""
    select currency_code, cast(sum({_exact("item_total_value")}) as decimal(38,2)) gmv,
      any_value(rate_to_usd) rate_to_usd,
      cast(cast(sum({_exact("item_total_value")}) as decimal(20,2))
        * cast(any_value(rate_to_usd) as decimal(17,10)) as decimal(38,8)) gmv_usd
    from fct_orders join exchange_rates on currency_code = 'BRL' group by all""",
}


def oracle_texts() -> dict[str, str]:
    ctes = {f"raw_{name}": text for name, text in duckdb_raw_tables().items()} | _STAGING | _MODELS
    head = "with " + ",\n".join(f"{name} as ({text})" for name, text in ctes.items())
    return {name: f"{head}\nselect * from ({text})" for name, text in _QUERIES.items()}
