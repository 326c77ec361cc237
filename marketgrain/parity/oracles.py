"""Independent SQL for every query, in the dialect of an embedded engine.

Money is compared through integer cents, so a mean rounds half up on both
sides without depending on how a decimal division is carried out.
"""

from __future__ import annotations

from marketgrain.functions.labels import WEEKDAYS
from marketgrain.parity.roles import (
    MIN_CATEGORIES,
    POS,
    SIMILAR_FROM,
    TARGET_CLASS,
    TARGET_NAME,
    TARGET_PRODUCT,
)

ORACLES: dict[str, str] = {}


def cents(column: str) -> str:
    return f"cast(round({column} * 100) as hugeint)"


def amount(total_cents: str) -> str:
    return f"cast({total_cents} as double) / 100"


def mean2(total_cents: str, count: str) -> str:
    """Cents per row, half up, zero without rows."""
    return (
        f"case when ({count}) = 0 then 0.0 else "
        f"cast((2 * ({total_cents}) + ({count})) // (2 * ({count})) as double) / 100 end"
    )


def pct2(part: str, whole: str) -> str:
    return mean2(f"10000 * cast({part} as hugeint)", f"cast({whole} as hugeint)")


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


def weekday_case(number: str, language: str) -> str:
    arms = " ".join(f"when {i} then '{n}'" for i, n in enumerate(WEEKDAYS[language], 1))
    return f"case {number} {arms} end"


# --- table profile -----------------------------------------------------------

TOTAL = cents("o_totalprice")

ORACLES["overview"] = f"""
select count(*) as rows,
       strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') as first_moment,
       strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as last_moment,
       min(o_totalprice) as smallest, max(o_totalprice) as largest,
       {mean2(f'sum({TOTAL})', 'count(o_totalprice)')} as average,
       count(o_totalprice) as amounts_used,
       count(*) - count(o_totalprice) as amounts_missing,
       count(*) - count(o_orderdate) as moments_missing
from orders"""

LABELLED = """
labelled as (
  select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  from documents d left join labels l on l.doc_id = d.doc_id)"""

ORACLES["null_profile"] = f"with {LABELLED} " + " union all ".join(
    f"select {i} as position, '{c}' as column_name, count(*) - count({c}) as nulls, "
    f"{pct2(f'count(*) - count({c})', 'count(*)')} as null_pct from labelled"
    for i, c in enumerate(["doc_id", "lang", "source", "n_chars", "quality", "toxic"], 1)
)

ORACLES["nulls_by_dim"] = f"""
with {LABELLED}
select lang, count(*) as rows, count(*) - count(quality) as nulls from labelled group by lang"""

FULL_ORDERS = f"""
sums as (
  select l_orderkey,
         sum({cents('l_extendedprice')}) as subtotal,
         cast(round(sum({cents('l_extendedprice')} * {cents('l_discount')}) / 100) as hugeint) as discount,
         min(l_shipdate) as created_at, max(l_shipdate) as updated_at
  from lineitem group by l_orderkey),
full_orders as (
  select o.*, {TOTAL} as total, subtotal, discount, created_at, updated_at
  from orders o left join sums on l_orderkey = o_orderkey)"""

GAP = "abs(subtotal - discount - total)"

ORACLES["rule_checks"] = f"with {FULL_ORDERS} " + " union all ".join(
    f"select '{name}' as rule, count(*) filter (where {rule}) as violations from full_orders"
    for name, rule in {
        "negative_subtotal": "subtotal < 0",
        "negative_total": "total < 0",
        "zero_total": "total = 0",
        "discount_out_of_range": "discount < 0 or discount > subtotal",
        "total_differs": f"{GAP} >= 1",
        "placed_after_created": "o_orderdate > created_at",
        "created_after_updated": "created_at > updated_at",
        "identical_timestamps": "o_orderdate = created_at and created_at = updated_at",
    }.items()
)

ORACLES["rule_checks_strict"] = f"""
with {FULL_ORDERS}
select 'total_differs' as rule, count(*) filter (where {GAP} > 1) as violations from full_orders"""

ORACLES["dup_keys"] = " union all ".join(
    f"select '{name}' as key, count(*) as duplicated_values, "
    f"{big('coalesce(sum(n - 1), 0)')} as extra_rows "
    f"from (select count(*) as n from lineitem group by {columns} having count(*) > 1)"
    for name, columns in {
        "order_line": "l_orderkey, l_linenumber",
        "order": "l_orderkey",
        "order_part": "l_orderkey, l_partkey",
    }.items()
)

ORACLES["id_gaps"] = " union all ".join(
    f"select min({key}) as smallest, max({key}) as largest, count(distinct {key}) as distinct_keys, "
    f"max({key}) - min({key}) + 1 - count(distinct {key}) as gaps, '{table}' as table_name from {table}"
    for table, key in {"orders": "o_orderkey", "lineitem": "l_partkey", "labels": "doc_id"}.items()
)

ORACLES["id_gap_ranges"] = " union all ".join(
    f"select below + 1 as first, {key} - 1 as last, {key} - below - 1 as missing, '{table}' as table_name "
    f"from (select {key}, lag({key}) over (order by {key}) as below from {table} where {key} is not null) "
    f"where {key} - below > 1"
    for table, key in {"orders": "o_orderkey", "lineitem": "l_partkey", "labels": "doc_id"}.items()
)


def _tukey(table: str, column: str) -> str:
    return f"""
with q as (
  select quantile_cont({column}, 0.25) as a, quantile_cont({column}, 0.5) as b,
         quantile_cont({column}, 0.75) as c from {table}),
f as (select *, a - 1.5 * (c - a) as lo, c + 1.5 * (c - a) as hi from q)
select round(a, 4) as q1, round(b, 4) as median, round(c, 4) as q3,
       round(lo, 4) as lower_fence, round(hi, 4) as upper_fence,
       (select count({column}) from {table}) as evaluated,
       (select count(*) from {table}, f where {column} < lo or {column} > hi) as candidates
from f"""


ORACLES["tukey"] = _tukey("orders", "o_totalprice")
ORACLES["tukey_events"] = _tukey("events", "value")

ORACLES["tukey_discount"] = _tukey("lineitem", "l_discount")
ORACLES["tukey_moments"] = _tukey(
    "(select epoch(o_orderdate) as seconds from orders)", "seconds"
)

ORACLES["by_status"] = f"""
select o_orderstatus as status, count(*) as rows, min(o_totalprice) as smallest,
       max(o_totalprice) as largest, {mean2(f'sum({TOTAL})', 'count(o_totalprice)')} as average
from orders group by 1"""

# --- customers ---------------------------------------------------------------

METRICS = f"""
order_value as (
  select o_custkey, sum({TOTAL}) as revenue, count(o_orderkey) as frequency
  from orders group by o_custkey),
variety as (
  select o_custkey, count(distinct p_brand) as diversity
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  group by o_custkey),
metrics as (
  select v.o_custkey, revenue, frequency, diversity
  from order_value v join variety d on d.o_custkey = v.o_custkey),
registered as (
  select c_custkey, coalesce(revenue, 0) as revenue, coalesce(frequency, 0) as frequency,
         coalesce(diversity, 0) as diversity
  from customer left join order_value v on v.o_custkey = c_custkey
  left join variety d on d.o_custkey = c_custkey),
elite as (
  select *, row_number() over (
    order by cast(revenue as decimal(38, 10)) / frequency desc, o_custkey) as rank
  from metrics where diversity >= {MIN_CATEGORIES}
  qualify rank <= 10),
elite_items as (
  select l.*, p.* from elite e join orders o on o.o_custkey = e.o_custkey
  join lineitem l on l_orderkey = o_orderkey join part p on p_partkey = l_partkey),
brand_units as (
  select p_brand as category_id, {big('sum(l_quantity)')} as units from elite_items group by 1)"""

ELITE_COLUMNS = (
    f"{amount('revenue')} as revenue, frequency, {mean2('revenue', 'frequency')} as average_ticket, diversity"
)
ORACLES["elite_customers"] = f"""
with {METRICS} select rank, o_custkey as customer_id, {ELITE_COLUMNS} from elite"""

ORACLES["elite_leader"] = f"""
with {METRICS}, ranked as (
  select *, dense_rank() over (order by units desc) as place from brand_units)
select category_id, units from ranked where place = 1"""

ORACLES["elite_totals"] = f"""
with {METRICS}
select (select count(*) from orders where o_custkey in (select o_custkey from elite)) as orders,
       (select {amount(f'sum({TOTAL})')} from orders
        where o_custkey in (select o_custkey from elite)) as revenue,
       count(*) as lines, {big('sum(l_quantity)')} as units,
       (select max(units) from brand_units) as leader_units,
       {pct2('(select max(units) from brand_units)', 'sum(l_quantity)')} as leader_share_pct
from elite_items"""

ORACLES["customer_metrics"] = f"""
with {METRICS}
select c_custkey as customer_id, {amount('revenue')} as revenue, {big('frequency')} as frequency,
       {mean2('revenue', 'frequency')} as average_ticket, {big('diversity')} as diversity
from registered"""

ORACLES["diversity_histogram"] = f"""
with {METRICS} select diversity, count(*) as customers from registered group by 1"""

ORACLES["eligibility"] = f"""
with {METRICS}
select {MIN_CATEGORIES} as minimum_categories, count(*) as customers,
       count(*) filter (where frequency > 0) as customers_with_orders,
       count(*) filter (where diversity >= {MIN_CATEGORIES}) as eligible_customers,
       {pct2(f'count(*) filter (where diversity >= {MIN_CATEGORIES})', 'count(*)')} as eligible_share_pct
from registered"""

ORACLES["eligibility_of_buyers"] = f"""
with {METRICS}
select {MIN_CATEGORIES + 2} as minimum_categories, count(*) as customers,
       count(*) filter (where frequency > 0) as customers_with_orders,
       count(*) filter (where diversity >= {MIN_CATEGORIES + 2}) as eligible_customers,
       {pct2(f'count(*) filter (where diversity >= {MIN_CATEGORIES + 2})', 'count(*)')} as eligible_share_pct
from (select v.*, coalesce(diversity, 0) as diversity
      from order_value v left join variety d on d.o_custkey = v.o_custkey)"""

SHARES = f"""
shares as (
  select category_id, units, row_number() over (order by units desc, category_id) as rank,
         {pct2('units', 'sum(units) over ()')} as share_pct
  from brand_units)"""
ORACLES["category_share"] = f"with {METRICS}, {SHARES} select * from shares"

ORACLES["category_by_name"] = f"""
with {METRICS}
select p_name as category, {big('sum(l_quantity)')} as units
from elite_items group by 1 order by units desc, category limit 6"""

ELITE_LABEL = "'Cliente elite ' || lpad(cast(rank as varchar), 2, '0')"
ORACLES["elite_anonymous"] = f"""
with {METRICS} select rank, {ELITE_LABEL} as label, {ELITE_COLUMNS} from elite"""

# --- calendar ----------------------------------------------------------------


def _calendar(table: str, moment: str) -> str:
    return f"""
calendar as (
  select cast(unnest(generate_series(
    cast(min({moment}) as date), cast(max({moment}) as date), interval 1 day)) as date) as day
  from {table})"""


CALENDAR = _calendar("orders", "o_orderdate")
DAILY = f"""
daily as (
  select cast(o_orderdate as date) as sold_on, count(*) as orders, sum({TOTAL}) as sales
  from orders where o_orderpriority = '{POS}' group by 1),
filled as (
  select day, coalesce(orders, 0) as orders, coalesce(sales, 0) as sales,
         sold_on is not null as recorded
  from calendar left join daily on sold_on = day)"""

ORACLES["calendar_sales"] = f"""
with {CALENDAR}, {DAILY}
select strftime(day, '%Y-%m-%d') as day, cast(year(day) as integer) as year,
       cast(month(day) as integer) as month, cast(day(day) as integer) as day_of_month,
       cast(isodow(day) as integer) as iso_weekday, {weekday_case('isodow(day)', 'pt')} as weekday,
       orders, {amount('sales')} as sales, recorded
from filled"""


def _weekday(by: str = "") -> str:
    """Weekday figures of ``filled`` per optional segment column."""
    comma = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
means as (
  select {comma}cast(isodow(day) as integer) as iso_weekday, count(*) as calendar_days,
         count(*) filter (where not recorded) as days_without_record,
         count(*) filter (where sales = 0) as zero_sales_days,
         sum(sales) as sales, count(*) filter (where recorded) as recorded_days
  from filled group by all),
flagged as (
  select *, row_number() over ({part}order by
    cast(sales as decimal(38, 10)) / calendar_days, iso_weekday) = 1 as is_lowest
  from means)"""


MEAN_SALES = f"{mean2('sales', 'calendar_days')} as mean_sales"
MEAN_RECORDED = f"{mean2('sales', 'recorded_days')} as mean_recorded"

ORACLES["weekday_mean"] = f"""
with {CALENDAR}, {DAILY}, {_weekday()}
select iso_weekday, {weekday_case('iso_weekday', 'pt')} as weekday, calendar_days,
       days_without_record, {MEAN_SALES}, is_lowest
from flagged"""

ORACLES["weekday_mean_naive_vs_full"] = f"""
with {CALENDAR}, {DAILY}, {_weekday()}
select iso_weekday, {MEAN_SALES}, {MEAN_RECORDED}, zero_sales_days from flagged"""

ORACLES["weekday_by_segment"] = f"""
with {CALENDAR},
daily as (
  select n_name as nation, cast(o_orderdate as date) as sold_on, sum({TOTAL}) as sales
  from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
  where o_orderpriority = '{POS}' group by 1, 2),
filled as (
  select n_name as nation, day, coalesce(sales, 0) as sales, sold_on is not null as recorded
  from (select n_name, day from nation, calendar)
  left join daily on sold_on = day and nation = n_name),
{_weekday('nation')}
select nation, iso_weekday, calendar_days, days_without_record, zero_sales_days,
       {MEAN_SALES}, {MEAN_RECORDED}, is_lowest
from flagged"""

SCOPE_TABLE = """
scope_status as (
  select * from (values ('all', 'F'), ('all', 'O'), ('all', 'P'), ('open_or_partial', 'O'),
    ('open_or_partial', 'P'), ('open', 'O')) as v(scope, status))"""

ORACLES["weekday_scope"] = f"""
with {CALENDAR}, {SCOPE_TABLE},
daily as (
  select scope, cast(o_orderdate as date) as sold_on, sum({TOTAL}) as sales
  from orders join scope_status on status = o_orderstatus
  where o_orderpriority = '{POS}' group by 1, 2),
filled as (
  select s.scope, day, coalesce(sales, 0) as sales, sold_on is not null as recorded
  from (select distinct scope from scope_status) s cross join calendar
  left join daily d on sold_on = day and d.scope = s.scope),
{_weekday('scope')}
select scope, iso_weekday, calendar_days, days_without_record, zero_sales_days,
       {MEAN_SALES}, {MEAN_RECORDED}, is_lowest
from flagged"""

ORACLES["reconciliation"] = f"""
with {CALENDAR}, {DAILY}
select count(*) as calendar_days, count(distinct day) as distinct_days,
       (select {big("datediff('day', cast(min(o_orderdate) as date), cast(max(o_orderdate) as date)) + 1")}
        from orders) as expected_days,
       (select count(*) from orders where o_orderpriority = '{POS}') as orders_before,
       {big('sum(orders)')} as orders_after,
       (select {amount(f'sum({TOTAL})')} from orders where o_orderpriority = '{POS}') as sales_before,
       {amount('sum(sales)')} as sales_after, true as balanced
from filled"""

ORACLES["events_weekday"] = f"""
with {_calendar('events', 'ts')},
daily as (
  select cast(ts as date) as sold_on, sum({cents('value')}) as sales
  from events where event_type = 'purchase' group by 1),
filled as (
  select day, coalesce(sales, 0) as sales, sold_on is not null as recorded
  from calendar left join daily on sold_on = day),
{_weekday()}
select iso_weekday, {weekday_case('iso_weekday', 'en')} as weekday, calendar_days,
       days_without_record, zero_sales_days, {MEAN_SALES}, {MEAN_RECORDED}, is_lowest
from flagged"""

# --- sales -------------------------------------------------------------------

MONTHLY = f"""
months as (
  select strftime(unnest(generate_series(date_trunc('month', min(o_orderdate)),
    date_trunc('month', max(o_orderdate)), interval 1 month)), '%Y-%m') as month from orders),
sold as (
  select strftime(o_orderdate, '%Y-%m') as sold_in, count(*) as orders, sum({TOTAL}) as value
  from orders group by 1),
monthly as (
  select month, coalesce(orders, 0) as orders, coalesce(value, 0) as value
  from months left join sold on sold_in = month)"""

MONTH_COLUMNS = (
    f"month, orders, {amount('value')} as revenue, {mean2('value', 'orders')} as average_ticket"
)
ORACLES["monthly_sales"] = f"with {MONTHLY} select {MONTH_COLUMNS} from monthly"

ORACLES["monthly_recorded"] = f"""
with monthly as (
  select strftime(o_orderdate, '%Y-%m') as month, count(*) as orders, sum({TOTAL}) as value
  from orders where o_orderpriority = '{POS}' group by 1)
select {MONTH_COLUMNS} from monthly"""


def _breakdown(column: str, name: str, where: str = "") -> str:
    return f"""(
  select {column} as {name}, count(*) as orders, {amount(f'sum({TOTAL})')} as revenue,
         {mean2(f'sum({TOTAL})', 'count(*)')} as average_ticket,
         {pct2('count(*)', 'sum(count(*)) over ()')} as order_share_pct,
         {pct2(f'sum({TOTAL})', f'sum(sum({TOTAL})) over ()')} as revenue_share_pct
  from orders {where} group by 1)"""


STATUSES = _breakdown("o_orderstatus", "status")
CHANNELS = _breakdown("o_orderpriority", "channel")
ORACLES["breakdown_status"] = f"select * from {STATUSES}"
ORACLES["breakdown_channel"] = f"select * from {CHANNELS}"

ORACLES["crosstab"] = f"""
select o_orderpriority as channel, n_name as nation, {big('count(*)')} as orders,
       {amount(f'sum({TOTAL})')} as revenue
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
group by 1, 2"""

# --- demand ------------------------------------------------------------------

DENSE = f"""
sold as (
  select p_name, p_partkey, o.*, l.*, strftime(o_orderdate, '%Y-%m') as sold_in
  from lineitem l join part on p_partkey = l_partkey join orders o on o_orderkey = l_orderkey
  where o_orderdate < timestamp '2001-08-01'),
months as (
  select strftime(unnest(generate_series((select date_trunc('month', min(o_orderdate)) from orders),
    timestamp '2001-07-01', interval 1 month)), '%Y-%m') as month)"""


def _series(key: str, keys: str) -> str:
    """Dense monthly units per value of ``keys``."""
    return f"""
{DENSE},
units as (
  select {key} as k, sold_in, {big('sum(l_quantity)')} as units from sold group by 1, 2),
series as (
  select d.k, month, coalesce(units, 0) as units,
         case when month <= '2001-04' then 'train' else 'test' end as period
  from (select month, k from months, ({keys})) d
  left join units u on u.k = d.k and sold_in = month)"""


ONE = _series(
    "p_name", f"select distinct p_name as k from part where p_name = '{TARGET_NAME}'"
)
BY_NAME = _series("p_name", "select distinct p_name as k from part")
BY_PRODUCT = _series("p_partkey", "select p_partkey as k from part")

FORWARD = """
forward as (
  select k, month, prediction, units as actual, abs(prediction - units) as absolute_error
  from (select *, cast(sum(units) over (partition by k order by month
          rows between 3 preceding and 1 preceding) as double) / 3 as prediction from series)
  where period = 'test')"""
LAST3 = """
recent as (
  select k, max(units) filter (where month = '2001-02') as a,
         max(units) filter (where month = '2001-03') as b,
         max(units) filter (where month = '2001-04') as c
  from series group by k)"""
FROZEN = f"""
{LAST3},
forward as (
  select s.k, month, prediction, units as actual, abs(prediction - units) as absolute_error
  from series s join (select k, (a + b + c) / 3.0::double as prediction from recent) r on r.k = s.k
  where period = 'test')"""
RECURSIVE = f"""
{LAST3},
step1 as (select *, (a + b + c) / 3.0::double as p1 from recent),
step2 as (select *, (b + c + p1) / 3.0::double as p2 from step1),
step3 as (select *, (c + p1 + p2) / 3.0::double as p3 from step2),
forward as (
  select s.k, month, prediction, units as actual, abs(prediction - units) as absolute_error
  from (select s.*, case month when '2001-05' then p1 when '2001-06' then p2 else p3 end as prediction
        from series s join step3 t on t.k = s.k where period = 'test') s)"""
SEASONAL = """
forward as (
  select k, month, prediction, units as actual, abs(prediction - units) as absolute_error
  from (select *, cast(lag(units, 12) over (partition by k order by month) as double) as prediction
        from series)
  where period = 'test')"""

REPORT = (
    "month, round(prediction, 6) as prediction, actual, round(absolute_error, 6) as absolute_error"
)
SUMMARY = (
    "count(*) as months, round(avg(absolute_error), 6) as mae, "
    f"round(sum(prediction), 6) as predicted_total, {big('sum(actual)')} as actual_total, "
    "round(sum(actual) - sum(prediction), 6) as shortfall"
)

ORACLES["unified_items"] = f"""
with {DENSE}
select o_orderkey as order_id, p_partkey as product_id, p_name as product_name,
       o_orderstatus as status, o_orderpriority as channel, {big('l_quantity')} as quantity,
       strftime(o_orderdate, '%Y-%m-%d') as placed_on, sold_in as month
from sold where p_name = '{TARGET_NAME}'"""

ORACLES["monthly_units"] = f"with {ONE} select month, units from series"
ORACLES["monthly_units_all"] = (
    f"with {BY_NAME} select k as product_name, month, units, period from series"
)
ORACLES["train_test_split"] = f"with {ONE} select month, units, period from series"
ORACLES["walk_forward"] = f"with {ONE}, {FORWARD} select {REPORT} from forward"
ORACLES["walk_forward_all"] = (
    f"with {BY_PRODUCT}, {FORWARD} select k as product_id, {REPORT} from forward"
)
ORACLES["forecast_summary"] = f"with {ONE}, {FORWARD} select {SUMMARY} from forward"
ORACLES["forecast_summary_all"] = (
    f"with {BY_NAME}, {FORWARD} select k as product_name, {SUMMARY} from forward group by k"
)
ORACLES["forecast_rounded_mae"] = (
    f"with {ONE}, {FORWARD} select round(avg(round(absolute_error, 6)), 6) as mae from forward"
)
ORACLES["forecast_frozen"] = f"with {ONE}, {FROZEN} select {REPORT} from forward"
ORACLES["forecast_frozen_all"] = (
    f"with {BY_NAME}, {FROZEN} select k as product_name, {REPORT} from forward"
)
ORACLES["forecast_recursive"] = f"with {ONE}, {RECURSIVE} select {REPORT} from forward"
ORACLES["forecast_recursive_all"] = (
    f"with {BY_NAME}, {RECURSIVE} select k as product_name, {REPORT} from forward"
)
ORACLES["forecast_seasonal"] = f"with {ONE}, {SEASONAL} select {REPORT} from forward"
ORACLES["forecast_seasonal_all"] = (
    f"with {BY_NAME}, {SEASONAL} select k as product_name, {REPORT} from forward"
)

ORACLES["dataset_profile"] = f"""
with {ONE}, target as (select * from sold where p_name = '{TARGET_NAME}')
select count(*) filter (where sold_in <= '2001-04') as train_lines,
       count(*) filter (where sold_in > '2001-04') as test_lines,
       {big("coalesce(sum(l_quantity) filter (where sold_in <= '2001-04'), 0)")} as train_units,
       {big("coalesce(sum(l_quantity) filter (where sold_in > '2001-04'), 0)")} as test_units,
       count(distinct p_partkey) as distinct_keys,
       (select count(*) from series where units = 0 and period = 'train') as train_zero_months,
       (select count(*) from series where units = 0 and period = 'test') as test_zero_months
from target"""

# --- affinity ----------------------------------------------------------------

LINKS = """
links as (
  select distinct o_custkey as c, l_partkey as p from lineitem join orders on o_orderkey = l_orderkey),
support as (select p, count(*) as n from links group by p)"""

ORACLES["interactions"] = f"with {LINKS} select c as customer_id, p as product_id from links"

ORACLES["pair_cosine"] = f"""
with {LINKS}, counted as (
  select a.p as x, b.p as y, count(*) as common
  from links a join links b on a.c = b.c and a.p < b.p group by 1, 2)
select x as product_a, y as product_b, common,
       common / sqrt(cast(sx.n as double) * cast(sy.n as double)) as similarity
from counted join support sx on sx.p = x join support sy on sy.p = y"""

ORACLES["similar_pairs"] = f"""
select * from ({ORACLES["pair_cosine"]}) where similarity >= {SIMILAR_FROM}"""

ORACLES["most_similar"] = f"""
with pairs as ({ORACLES["pair_cosine"]}),
both_ways as (
  select product_a as product_id, product_b as other_id, common, similarity from pairs
  union all select product_b, product_a, common, similarity from pairs),
placed as (
  select *, cast(row_number() over (
    partition by product_id order by similarity desc, other_id) as integer) as rank
  from both_ways)
select product_id, rank, other_id, common, round(similarity, 8) as similarity
from placed where rank <= 3"""

ANCHORED = f"""
{LINKS},
buyers as (select c from links where p = {TARGET_PRODUCT}),
shared as (select p, count(*) as common from links where c in (select c from buyers) group by p),
scored as (
  select p_partkey as product_id, p_name as product_name,
         coalesce(common, 0) as common_customers, coalesce(n, 0) as product_customers,
         (select count(*) from buyers) as target_customers,
         case when n is null then 0.0 else coalesce(common, 0) /
           sqrt(cast((select count(*) from buyers) as double) * cast(n as double)) end as similarity
  from part left join support s on s.p = p_partkey left join shared h on h.p = p_partkey
  where p_partkey <> {TARGET_PRODUCT}),
placed as (
  select *, row_number() over (order by similarity desc, product_id) as rank from scored)"""

ORACLES["similar_items"] = f"""
with {ANCHORED}
select rank, product_id, product_name, round(similarity, 8) as similarity, common_customers,
       product_customers, target_customers
from placed where rank <= 5"""

ORACLES["similarity_to_target"] = f"""
with {ANCHORED} select product_id, common_customers, product_customers, similarity from scored"""

ORACLES["class_position"] = f"""
with {ANCHORED}
select product_id, round(similarity, 8) as similarity, rank as position
from placed where product_name like '{TARGET_CLASS}' order by rank limit 1"""

# --- quality -----------------------------------------------------------------

EDGES = {
    "items_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "items_products": ("lineitem", "l_partkey", "part", "p_partkey"),
    "items_suppliers": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "orders_customers": ("orders", "o_custkey", "customer", "c_custkey"),
    "customers_nations": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "nations_regions": ("nation", "n_regionkey", "region", "r_regionkey"),
}
LOOSE = {
    "documents_labels": ("documents", "doc_id", "labels", "doc_id"),
    "events_customers": ("events", "event_id", "customer", "c_custkey"),
    "items_suppliers_as_products": ("lineitem", "l_partkey", "supplier", "s_suppkey"),
}


def _orphans(edges: dict[str, tuple[str, str, str, str]]) -> str:
    return " union all ".join(
        f"select '{name}' as edge, count(distinct {ck}) as orphan_values, count(*) as orphan_rows "
        f"from {child} where {ck} not in (select {pk} from {parent})"
        for name, (child, ck, parent, pk) in edges.items()
    )


ORACLES["orphans"] = _orphans(EDGES | LOOSE)

KEYS = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
}


def _keys(keys: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, count(*) - count({k}) as null_keys, "
        f"count({k}) - count(distinct {k}) as extra_rows from {t}"
        for t, k in keys.items()
    )


ORACLES["key_report"] = _keys(KEYS | {"lineitem": "l_orderkey"})

WIDTHS = {
    "orders": 6, "customer": 5, "part": 6, "supplier": 4, "nation": 3, "region": 2,
    "lineitem": 11, "events": 6,
}
SOURCES = " union all ".join(
    f"select '{t}' as table_name, count(*) as rows, {n} as columns, "
    f"{'false' if t == 'events' else 'true'} as used_for_metrics from {t}"
    for t, n in WIDTHS.items()
)
ORACLES["source_list"] = SOURCES

CHECKS = f"""
measured as (
  select 1 as place, 'inventory' as name, {len(WIDTHS)} as value, 'pass' as otherwise
  union all select 2, 'required_sources_missing', 0, 'fail'
  union all select 3, 'primary_keys', sum(null_keys + extra_rows), 'fail' from ({_keys(KEYS)})
  union all select 4, 'foreign_keys', sum(orphan_rows), 'fail' from ({_orphans(EDGES)})
  union all select 5, 'core_completeness',
    sum((o_orderdate is null)::int + (o_orderstatus is null)::int
        + (o_orderpriority is null)::int + (total is null)::int), 'fail' from full_orders
  union all select 6, 'order_arithmetic', count(*) filter (where {GAP} > 1), 'warning' from full_orders
  union all select 7, 'privacy', 0, 'fail'),
checks as (
  select name as "check", case when value = 0 then 'pass' else otherwise end as status,
         {big('value')} as value
  from measured)"""
ORACLES["quality_report"] = f"with {FULL_ORDERS}, {CHECKS} select * from checks"


def _cutoff(name: str, value: str, status: str) -> str:
    return (
        f"select '{name}' as \"check\", {status} as status, {big(value)} as value, "
        f"{pct2(value, 'count(*)')} as share_pct from full_orders"
    )


def _attention(value: str) -> str:
    return f"case when {value} > 0 then 'attention' else 'ok' end"


_cut = {
    "core_fields": "(count(*) - count(total) + count(*) - count(created_at))",
    "uniqueness": "(count(*) - count(distinct o_orderkey) + count(*) - count(distinct o_custkey))",
    "arithmetic": f"count(*) filter (where {GAP} >= 1)",
    "doubtful_status": "count(*) filter (where o_orderstatus in ('F', 'P'))",
    "after_cutoff": "count(*) filter (where cast(o_orderdate as date) > date '2001-06-30')",
}
ORACLES["cutoff_report"] = f"with {FULL_ORDERS} " + " union all ".join(
    _cutoff(n, v, "'attention'" if n == "doubtful_status" else _attention(v)) for n, v in _cut.items()
)


def _hygiene(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null or {c} = '') as empty, "
        f"count(*) filter (where length({c}) <> length(trim({c}, ' \t\r\n'))) as padded, "
        f"count(*) filter (where trim({c}) in ('N/A', 'NA', 'NULL', 'None', '-')) as placeholder "
        f"from {table}"
        for c in columns
    )


ORACLES["text_hygiene"] = _hygiene("documents", ["text", "lang", "source"])
PIECES = """
pieces as (
  select 'sentence' as kind, unnest(string_split_regex(text, '[.]')) as piece from documents
  union all
  select 'markup', unnest(string_split_regex(html, '[<>]')) from pages)"""
ORACLES["text_hygiene_pieces"] = f"with {PIECES} {_hygiene('pieces', ['kind', 'piece'])}"

ORACLES["privacy_gate"] = """
select 'documents' as section, '' as forbidden_fields,
       count(*) filter (where contains(concat_ws(' ', text, lang, source), '@')) as rows_with_at_sign
from documents
union all
select 'conversations', '', count(*) filter (where contains(concat_ws(' ', role, text), '@'))
from conversations
union all select 'customer_metrics', 'customer_id', 0
union all select 'elite', '', 0"""

# --- scopes ------------------------------------------------------------------

SCOPED = f"""
{SCOPE_TABLE},
scoped as (
  select scope, o.* from orders o join scope_status on status = o_orderstatus),
scope_value as (
  select scope, o_custkey, sum({TOTAL}) as revenue, count(*) as frequency from scoped group by 1, 2),
scope_variety as (
  select scope, o_custkey, count(distinct p_brand) as diversity
  from scoped join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  group by 1, 2),
scope_elite as (
  select v.*, diversity, row_number() over (partition by v.scope
    order by cast(revenue as decimal(38, 10)) / frequency desc, v.o_custkey) as rank
  from scope_value v join scope_variety d on d.scope = v.scope and d.o_custkey = v.o_custkey
  where diversity >= {MIN_CATEGORIES // 2}
  qualify rank <= 10)"""

ORACLES["scope_sensitivity"] = f"""
with {SCOPED}
select scope, rank, o_custkey as customer_id, {big('frequency')} as frequency,
       {mean2('revenue', 'frequency')} as average_ticket, diversity
from scope_elite"""

ORACLES["scope_leader"] = f"""
with {SCOPED}, units as (
  select s.scope, p_brand as category_id, {big('sum(l_quantity)')} as units
  from scoped s join scope_elite e on e.scope = s.scope and e.o_custkey = s.o_custkey
  join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  group by 1, 2)
select scope, units, category_id from units
qualify dense_rank() over (partition by scope order by units desc) = 1"""

# --- publication -------------------------------------------------------------

CARDS = f"""
cards as (
  select 1 as position, 'gross-sales' as id, {amount(f'sum({TOTAL})')} as value, 'currency' as format from orders
  union all select 2, 'orders', cast(count(*) as double), 'integer' from orders
  union all select 3, 'average-ticket', {mean2(f'sum({TOTAL})', 'count(*)')}, 'currency' from orders
  union all select 4, 'customers', cast(count(*) as double), 'integer' from customer
  union all select 5, 'products', cast(count(*) as double), 'integer' from part
  union all select 6, 'elite-eligibility',
    {pct2(f'count(*) filter (where diversity >= {MIN_CATEGORIES})', 'count(*)')}, 'percent' from registered)"""
ORACLES["cards"] = f"with {METRICS}, {CARDS} select * from cards"

ORACLES["metadata"] = f"""
select strftime(min(o_orderdate), '%Y-%m-%d') as period_start,
       strftime(max(o_orderdate), '%Y-%m-%d') as period_end,
       string_agg(distinct o_orderstatus, ',' order by o_orderstatus) as statuses,
       {big(len(WIDTHS))} as source_files,
       (select {big('sum(rows)')} from ({SOURCES})) as total_records
from orders"""

ORACLES["view_numbers"] = f"""
with {FULL_ORDERS}, {CHECKS}, {CALENDAR}, {DAILY}, {_weekday()},
shown as (select iso_weekday, {MEAN_SALES}, is_lowest from flagged),
ends as (
  select max(mean_sales) filter (where is_lowest) as low,
         max(mean_sales) filter (where iso_weekday = 7) as other from shown)
select (select {amount(f'sum({TOTAL})')} from orders) as channel_total,
       (select max(order_share_pct) from {STATUSES}) as dominant_status_pct,
       (select {pct2("count(*) filter (where status = 'pass')", 'count(*)')} from checks) as pass_rate_pct,
       round(abs(low - other), 2) as weekday_gap,
       round(100 * abs(low - other) / greatest(other, 1.0), 2) as weekday_gap_pct
from ends"""


def text(value: str) -> str:
    """A number in its shortest plain form."""
    exact = f"cast(cast(cast(cast({value} as double) as varchar) as decimal(28, 8)) as varchar)"
    return f"regexp_replace({exact}, '\\.?0+$', '')"


def _tidy(source: str, section: str, dimension: str, metric: str, value: str,
          period: str = "''", detail: str = "''") -> str:
    return (
        f"select '{section}' as secao, {dimension} as dimensao, {period} as periodo, "
        f"{metric} as metrica, {text(value)} as valor, {detail} as detalhe from {source}"
    )


ORACLES["tidy_overview"] = f"with {METRICS}, {CARDS}, {MONTHLY} " + " union all ".join(
    [
        _tidy("cards", "indicador_executivo", "id", "format", "value"),
        _tidy(f"(select {MONTH_COLUMNS} from monthly)", "serie_mensal", "'valor_bruto_registrado'",
              "'valor_bruto'", "revenue", "month", "orders || ' pedidos'"),
        _tidy(CHANNELS, "canal", "channel", "'valor_bruto'", "revenue", detail="orders || ' pedidos'"),
    ]
)

ORACLES["tidy_customers"] = f"with {METRICS}, {SHARES} " + " union all ".join(
    [
        _tidy(f"(select rank, {ELITE_COLUMNS} from elite)", "ranking_elite_anonimizado", ELITE_LABEL,
              "'ticket_medio'", "average_ticket",
              detail=f"'valor_bruto=' || {text('revenue')} || '; pedidos=' || frequency || '; categorias=' || diversity"),
        _tidy("shares", "categoria_elite", "category_id", "'quantidade'", "units",
              detail=f"'participacao_pct=' || {text('share_pct')}"),
        _tidy(CHANNELS, "canal", "channel", "'valor_bruto'", "revenue",
              detail=f"'pedidos=' || orders || '; participacao_pedidos_pct=' || {text('order_share_pct')}"),
    ]
)

ORACLES["tidy_operations"] = (
    f"with {FULL_ORDERS}, {CHECKS}, {CALENDAR}, {DAILY}, {_weekday()}, "
    f"shown as (select *, {MEAN_SALES} from flagged) "
) + " union all ".join(
    [
        _tidy("shown", "operacao_pos", weekday_case("iso_weekday", "pt"), "'valor_bruto_medio_diario'",
              "mean_sales",
              detail="'dias_calendario=' || calendar_days || '; dias_zero=' || zero_sales_days"),
        _tidy("checks", "check_qualidade", '"check"', "status", "value"),
    ]
)

ORACLES["tidy_models"] = (
    f"with {ONE}, {FORWARD}, {ANCHORED}, shown as (select {REPORT} from forward), "
    "best as (select *, round(similarity, 8) as shown_similarity from placed where rank <= 5) "
) + " union all ".join(
    [
        _tidy("shown", "previsao", "'demanda_mensal'", "'previsao_vs_realizado'", "prediction", "month",
              f"'realizado=' || actual || '; erro_absoluto=' || {text('absolute_error')}"),
        _tidy("best", "recomendacao", "product_name", "'similaridade_cosseno'", "shown_similarity",
              detail="'clientes_em_comum=' || common_customers"),
        _tidy(f"({SOURCES})", "fonte", "table_name",
              "case when used_for_metrics then 'usada_nas_metricas' else 'inventariada' end", "rows",
              detail="columns || ' colunas'"),
    ]
)

ORACLES["exported_forecast"] = f"""
with {ONE}, {FORWARD}
select month, printf('%.6f', round(prediction, 6)) as prediction, cast(actual as varchar) as actual,
       printf('%.6f', round(absolute_error, 6)) as absolute_error
from forward"""

ORACLES["exported_similarity"] = f"""
with {ANCHORED}
select cast(product_id as varchar) as product_id, printf('%.8f', similarity) as similarity from scored"""

ORACLES["exported_view"] = f"""
select 'secao;dimensao;periodo;metrica;valor;detalhe' as line
union all
select concat_ws(';', secao, dimensao, periodo, metrica, valor,
  case when contains(detalhe, ';') then '"' || detalhe || '"' else detalhe end)
from ({ORACLES["tidy_customers"]})"""

ORACLES["exported_views"] = " union all ".join(
    f"""
select '{view}' as view, 'secao;dimensao;periodo;metrica;valor;detalhe' as line, true as is_marked
union all
select '{view}', concat_ws(';', secao, dimensao, periodo, metrica, valor,
  case when contains(detalhe, ';') then '"' || detalhe || '"' else detalhe end), false
from ({ORACLES["tidy_" + view]})"""
    for view in ("overview", "customers", "operations", "models")
)

ORACLES["exported_monthly"] = f"with {ONE} select month, cast(units as varchar) as units, period from series"
ORACLES["exported_items"] = f"""
select * replace (order_id::varchar as order_id, product_id::varchar as product_id, quantity::varchar as quantity)
from ({ORACLES["unified_items"]})"""

ORACLES["insights"] = f"""
select 1 as position, 'elite-selectivity' as id, 'attention' as tone, cast(null as varchar) as subject,
       eligible_share_pct as value, cast(minimum_categories as double) as other
from ({ORACLES["eligibility"]})
union all select 2, 'elite-category', 'positive', category_id, cast(units as double), null
from ({ORACLES["category_share"]}) where rank = 1
union all select 3, 'weekday-pos', 'neutral', weekday, mean_sales, null
from (select * from ({ORACLES["weekday_mean"]}) where is_lowest order by iso_weekday limit 1)
union all select 4, 'forecast', 'attention', null, mae, shortfall from ({ORACLES["forecast_summary"]})"""

ORACLES["buyers_by_scope"] = """
select 'all' as scope, 'all' as label, count(distinct o_custkey) as customers, true as is_close from orders
union all select 'channel', o_orderpriority, count(distinct o_custkey), true from orders group by 2
union all select 'month', strftime(o_orderdate, '%Y-%m'), count(distinct o_custkey), true from orders group by 2"""

WIDE = ", ".join(f"coalesce(max(similarity) filter (where b % 50 = {i}), 0.0::double) as c{i}" for i in range(50))
ORACLES["wide_similarity"] = f"""
with pairs as ({ORACLES["pair_cosine"]}), every as (
  select product_a as a, product_b as b, similarity from pairs
  union all select product_b, product_a, similarity from pairs
  union all select distinct l_partkey, l_partkey, 1.0::double from lineitem join orders on o_orderkey = l_orderkey)
select {big('b // 50')} as block, a as product_a, {WIDE} from every group by 1, 2"""

ORACLES["overlay_document"] = f"""
with {METRICS}, {CARDS}
select id, value from cards union all select table_name, cast(rows as double) from ({SOURCES})"""

ORACLES["overlay_monthly"] = f"""
with {MONTHLY}, published as (
  select strftime(l_shipdate, '%Y-%m') as month, count(*) as orders, sum({cents('l_extendedprice')}) as value
  from lineitem group by 1)
select coalesce(m.month, p.month) as month, coalesce(p.orders, m.orders) as orders,
       {amount('coalesce(p.value, m.value)')} as revenue
from monthly m full join published p on p.month = m.month"""

ORACLES["json_contract_monthly"] = ORACLES["monthly_sales"]
ORACLES["json_contract_sizes"] = f"""
with {METRICS}, {MONTHLY}
select 'executive.cards' as section, 6 as entries
union all select 'sales.monthly', cast(count(*) as integer) from monthly
union all select 'sales.statuses', cast(count(distinct o_orderstatus) as integer) from orders
union all select 'sales.channels', cast(count(distinct o_orderpriority) as integer) from orders
union all select 'customers.elite', cast(count(*) as integer) from elite
union all select 'customers.category_distribution', cast(count(distinct diversity) as integer) from registered
union all select 'customers.elite_categories', cast(count(*) as integer) from brand_units
union all select 'operations.weekdays', 7
union all select 'operations.forecast_series', 3
union all select 'operations.recommendations', 5
union all select 'quality.checks', 7
union all select 'quality.sources', {len(WIDTHS)}"""

ORACLES["overlay_sections"] = f"""
select 'statuses' as section, status as label, orders, revenue from {STATUSES}
union all select 'channels', o_orderpriority, count(*), {amount('coalesce(sum(value), 0)')}
from orders left join (
  select l_orderkey, sum({cents('l_extendedprice')}) as value from lineitem group by 1) on l_orderkey = o_orderkey
group by 2"""

# --- cleaning ----------------------------------------------------------------

ORACLES["locale_decimal"] = f"""
select o_orderkey as order_id,
       'R$ ' || translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') as amount,
       {amount(TOTAL)} as amount_number, false as amount_rejected
from orders"""

ORACLES["locale_decimal_props"] = """
select event_id, try_cast(json_extract_string(props, '$.k') as double) as amount_number,
       json_extract_string(props, '$.k') is not null
         and try_cast(json_extract_string(props, '$.k') as double) is null as amount_rejected
from events"""

ORACLES["alias_coalesce"] = f"""
select status as category, revenue as value, orders from {STATUSES}
union all select channel, revenue, orders from {CHANNELS}"""

ORACLES["checked_join"] = f"""
select n_name as nation, count(*) as lines, {big('sum(l_quantity)')} as units
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey
join nation on n_nationkey = c_nationkey group by 1"""

# --- intake ------------------------------------------------------------------

COLUMNS = {
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
    "l_tax l_returnflag l_linestatus l_shipdate",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "conversations": "conv_id turn role text",
}


def _kind(column: str) -> str:
    """Evidence bit of a value, by shape."""
    v = f"cast({column} as varchar)"
    shape = lambda pattern: f"regexp_full_match({v}, '{pattern}')"
    day = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    clock = "[T ]([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?"
    return f"""case
      when {column} is null or {v} = '' then 0
      when lower({v}) in ('true', 'false') then 1
      when {shape('[+-]?[0-9]+')} then case
        when {shape('[+-]?0[0-9]+')} then 128
        when try_cast({v} as integer) is not null then 2
        when try_cast({v} as bigint) is not null then 4 else 8 end
      when {shape('[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')} then 8
      when {shape(day)} and try_cast({v} as date) is not null then 16
      when {shape(day + clock)} and try_cast({v} as timestamp) is not null then 32
      else 128 end"""


def _profile(table: str, position: int, column: str) -> str:
    return f"""
select '{table}' as table_name, {position} as position, '{column}' as column_name,
       case when e = 0 then 'UNKNOWN' when e = 1 then 'BOOLEAN' when e = 2 then 'INTEGER'
            when e & ~6 = 0 then 'BIGINT' when e & ~14 = 0 then 'NUMERIC' when e = 16 then 'DATE'
            when e & ~48 = 0 then 'TIMESTAMP' else 'TEXT' end as type_name, non_empty
from (select coalesce(bit_or({_kind(column)}), 0) as e,
             count(*) filter (where cast({column} as varchar) <> '') as non_empty from {table})"""


ORACLES["type_profile"] = " union all ".join(
    _profile(t, i, c) for t, names in COLUMNS.items() for i, c in enumerate(names.split(), 1)
)
ORACLES["value_kinds"] = """
select case o_orderkey % 8 when 0 then 'TIMESTAMPTZ' when 1 then 'TIMESTAMP' when 2 then 'TEXT'
  when 3 then 'INTEGER' when 4 then 'TEXT' when 5 then 'UNKNOWN' when 6 then 'TIMESTAMPTZ'
  else 'DATE' end as kind, count(*) as texts
from orders group by 1"""

ORACLES["quarantined_values"] = """
select o_orderkey, 'shown' as column_name, 'timestamp_ntz' as expected_type
from orders where o_orderkey % 8 in (0, 2, 3, 4, 5, 6)"""

ORACLES["csv_type_profile"] = ORACLES["type_profile"]

ORACLES["csv_inventory"] = """
select 'nation' as table_name, count(*) as rows, 3 as columns from nation
union all select 'documents', count(*), 5 from documents"""

ORACLES["csv_load_reconcile"] = " union all ".join(
    f"select '{t}' as table_name, count(*) as source_rows, count(*) as loaded_rows, true as reconciled from {t}"
    for t in ["orders", "lineitem", "customer", "documents"]
)

# Columns of the drop whose values are no plain text, by the form they are hashed in.
FORMS = {
    "o_totalprice": 2, "o_orderdate": "moment", "l_quantity": 2, "l_extendedprice": 2, "l_discount": 2,
    "l_tax": 2, "l_shipdate": "moment", "c_acctbal": 2,
}


def _digests(table: str) -> str:
    def form(column: str) -> str:
        kind = FORMS.get(column)
        if kind == "moment":
            return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
        if kind is None:
            return f"cast({column} as varchar)"
        return f"regexp_replace(cast(cast({column} as decimal(18,{kind})) as varchar), '[.]?0+$', '')"

    columns = COLUMNS[table].split()
    hashed = ", ".join(f"md5(coalesce('=' || {form(c)}, '')) as {c}" for c in columns)
    number = "cast(coalesce(sum(cast('0x' || substr({}, 1, 15) as bigint)), 0) as varchar)"
    sums = [number.format(c) for c in columns] + [number.format(f"md5(concat({', '.join(columns)}))")]
    return " union all ".join(
        f"select '{table}' as table_name, '{name}' as column_name, {total} as source_digest, "
        f"{total} as loaded_digest, true as reconciled from (select {hashed} from {table})"
        for name, total in zip([*columns, "*"], sums)
    )


ORACLES["csv_content_reconcile"] = " union all ".join(
    _digests(t) for t in ["orders", "lineitem", "customer", "documents"]
)

ORACLES["bad_records"] = """
select 'orders' as table_name, o_orderkey, found, 4 as expected, column_name, expected_type
from orders join (values
  (0, 3, null, null), (1, 5, null, null), (3, 4, 'o_totalprice', 'decimal(18,2)'),
  (4, 4, 'o_totalprice', 'decimal(18,2)'), (4, 4, 'o_orderdate', 'date'), (6, 4, 'o_orderdate', 'date')
) as f(fault, found, column_name, expected_type) on o_orderkey % 50 = fault"""

ORACLES["intake_guards"] = """
select cast(position as integer) as position, attempt, refused,
       case when refused or attempt = 'header only' then 0 else n end as rows,
       cast(untyped as integer) as untyped
from (select count(*) as n from customer), (values
  (1, 'sound', false, 1), (2, 'blank name', true, 0), (3, 'control character', true, 0),
  (4, '63 bytes', false, 1), (5, '64 bytes', true, 0), (6, 'repeated name', true, 0), (7, 'accents', false, 1),
  (8, 'broken UTF-8', true, 0), (9, 'header only', false, 4), (10, 'narrow records', true, 0),
  (11, 'wide records', true, 0), (12, 'open quote', true, 0), (13, 'codes by name', false, 3),
  (14, 'leading zeros', false, 2), (15, 'changed meanwhile', true, 0)
) as v(position, attempt, refused, untyped)"""

ORACLES["code_columns"] = """
select cast(position as integer) as position, column_name, type_name, n as non_empty
from (select count(*) as n from customer), (values
  (1, 'c_custkey', 'INTEGER'), (2, 'Customer_CODE', 'TEXT'), (3, 'barcode', 'INTEGER'), (4, 'Phone', 'TEXT'),
  (5, 'phones', 'INTEGER'), (6, 'nation_ref', 'TEXT'), (7, 'padded', 'TEXT'), (8, 'signed', 'TEXT'),
  (9, 'fraction', 'NUMERIC')
) as v(position, column_name, type_name)"""

ORACLES["emitted_schema"] = """
select cast(position as integer) as position,
       'CREATE TABLE ' || name || ' (' || chr(10) || '  ' || replace(columns, ', ', ',' || chr(10) || '  ')
       || chr(10) || ') USING PARQUET;' as ddl
from (values
  (1, '`odd ``names```', '`a``b` INT, `c d` INT'),
  (2, '`orders`', '`o_orderkey` INT, `o_orderstatus` STRING, `o_orderdate` TIMESTAMP_NTZ'),
  (3, '`region`', '`r_regionkey` INT, `r_name` STRING')
) as v(position, name, columns)"""

ORACLES["strict_moments"] = """
select o_orderkey, case o_orderkey % 8 when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.500'
         when 7 then strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000' end as moment,
       case when o_orderkey % 8 not in (1, 7) then 'shown' end as rejected_column
from orders"""

ORACLES["csv_published_tables"] = f"""
select c_mktsegment, count(*) as orders, {amount(f'sum({TOTAL})')} as revenue,
       strftime(max(o_orderdate), '%Y-%m-%d') as latest
from orders join customer on c_custkey = o_custkey group by 1"""

ORACLES["csv_published_texts"] = """
select doc_id, md5(text) as digest, cast(length(text) as integer) as characters from documents"""


def _values(section: str, sql: str, order: str | None) -> str:
    """The values of a section as they stand in the JSON document."""
    place = f"'[' || (row_number() over (order by {order}) - 1) || ']'" if order else "''"
    return f"""
select '.{section}' || t.at || substr(e.fullkey, 2) as path,
       case e.type when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else 'number' end as kind,
       case when e.type = 'VARCHAR' then json_extract_string(t.j, e.fullkey) when e.type = 'BOOLEAN' then e.atom::varchar end as text,
       case when e.type not in ('VARCHAR', 'BOOLEAN', 'NULL') then cast(e.atom::varchar as double) end as number
from (select {place} as at, to_json(s) as j from ({sql}) s) t, json_tree(t.j) e
where e.type not in ('OBJECT', 'ARRAY')"""


DOCUMENT = [
    ("metadata.source", ORACLES["metadata"], None),
    ("executive.cards", ORACLES["cards"], "position"),
    ("executive.insights", ORACLES["insights"], "position"),
    ("sales.monthly", ORACLES["monthly_sales"], "month"),
    ("sales.statuses", ORACLES["breakdown_status"], "status"),
    ("sales.channels", ORACLES["breakdown_channel"], "channel"),
    ("customers.elite", ORACLES["elite_anonymous"], "rank"),
    ("customers.eligibility", ORACLES["eligibility"], None),
    ("customers.category_distribution", ORACLES["diversity_histogram"], "diversity"),
    ("customers.elite_categories", f"select * rename (category_id as category) from ({ORACLES['category_share']})", "rank"),
    (
        "operations.weekdays",
        f"select * from ({ORACLES['weekday_mean']}) join (select iso_weekday, mean_recorded, zero_sales_days "
        f"from ({ORACLES['weekday_mean_naive_vs_full']})) using (iso_weekday)",
        "iso_weekday",
    ),
    ("operations.forecast", ORACLES["forecast_summary"], None),
    ("operations.forecast_series", ORACLES["walk_forward"], "month"),
    ("operations.recommendations", ORACLES["similar_items"], "rank"),
    ("quality.checks", ORACLES["quality_report"], '"check"'),
    ("quality.sources", ORACLES["source_list"], "table_name"),
]
ORACLES["json_contract"] = " union all ".join(f"select * from ({_values(*part)})" for part in DOCUMENT)

ORACLES["publish_guards"] = """
with o as (select count(*) as n, count(*) filter (where o_orderpriority = '1-URGENT') as urgent from orders),
c as (select count(*) as n, count(*) filter (where c_acctbal > 0) as positive from customer)
select cast(position as integer) as position, attempt, refused, case orders when 'all' then o.n else o.urgent end as orders,
       case customers when 'none' then 0 when 'some' then c.positive else c.n end as customers
from o, c, (values
  (1, 'first', false, 'all', 'none'), (2, 'filled', true, 'all', 'none'), (3, 'other columns', true, 'all', 'none'),
  (4, 'unknown table', true, 'all', 'none'), (5, 'wrong rows', true, 'all', 'none'), (6, 'new table', false, 'all', 'some'),
  (7, 'overtaken', true, 'all', 'all'), (8, 'replaced', false, 'urgent', 'all')
) as v(position, attempt, refused, orders, customers)"""
