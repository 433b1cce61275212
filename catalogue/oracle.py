"""The same results in plain SQL over the test tables."""

from __future__ import annotations

ORDERS = """inc as (
  select o.o_orderkey as id, o.o_orderdate as ts,
    'BLOCK ' || cast(c.c_custkey as varchar) as block,
    lpad(cast(c.c_nationkey + 1 as varchar), 2, '0') || '1'
      || cast(c.c_custkey % 10 as varchar) as unit,
    cast(c.c_nationkey + 1 as integer) as district,
    o.o_orderpriority as category,
    case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as violent,
    case when o.o_orderstatus = 'F' then 1 else 0 end as arrest,
    case when c.c_mktsegment = 'HOUSEHOLD' then 1 else 0 end as domestic
  from orders o join customer c on o.o_custkey = c.c_custkey)"""

EVENTS = """inc as (
  select event_id as id, ts, cast(user_id as varchar) as block, event_type as category,
    case when event_type in ('error', 'purchase') then 1 else 0 end as violent,
    case when event_type = 'purchase' then 1 else 0 end as arrest
  from events)"""

YEARS = range(1995, 2001)


def r(expression: str, digits: int = 6) -> str:
    """Rounded double; adding zero turns a negative zero into zero."""
    return f"(round(cast({expression} as double), {digits}) + cast(0 as double))"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


def small(expression: str) -> str:
    return f"cast({expression} as integer)"


N = big("count(*)") + " as n"
MONTH = small("month(ts)")
HOUR = small("hour(ts)")
DOW = small("dayofweek(ts) + 1")
YEAR = small("year(ts)")
HITS = big("sum(violent)")


def profile(source: str, name: str, bucket: str, more: str = "", where: str = "true") -> str:
    return (
        f"with {source} select {bucket} as {name}, {N}{more} from inc where {where} group by 1"
    )


# --- panel and features -----------------------------------------------------


def panel(keys: str = "unit", year: str = "isoyear(ts)") -> str:
    return f"""{ORDERS}, panel as (
      select {keys}, {small(year)} as year, {small('week(ts)')} as week,
        {big('count(id)')} as total, {HITS} as violent,
        avg(cast(arrest as double)) as arrest_rate,
        avg(cast(domestic as double)) as domestic_rate
      from inc group by {keys}, {year}, week(ts))"""


# The districts as units.
PANEL_OF_DISTRICTS = panel().replace(
    "from inc group by",
    "from (select * replace (lpad(cast(district as varchar), 2, '0') as unit) from inc) group by",
)

DENSE = f"""{panel()}, dated as (
  select *, date_trunc('week', make_date(year, 1, 4)) + to_days((week - 1) * 7) as monday
  from panel), spans as (
  select unit, min(monday) as first_monday, max(monday) as last_monday from dated group by 1),
  weeks as (
  select unit, unnest(generate_series(first_monday, last_monday, interval 7 days)) as monday
  from spans), dense as (
  select w.unit, {small('isoyear(w.monday)')} as year, {small('week(w.monday)')} as week,
    coalesce(d.total, 0) as total, coalesce(d.violent, 0) as violent,
    coalesce(d.arrest_rate, 0) as arrest_rate, coalesce(d.domestic_rate, 0) as domestic_rate
  from weeks w left join dated d on w.unit = d.unit and w.monday = d.monday)"""

RATES = f"{r('arrest_rate')} as arrest_rate, {r('domestic_rate')} as domestic_rate"

SHARES = f"""{r('case when total <> 0 then violent / cast(total as double) else 0 end')}
    as violent_share,
  {r('case when violent <> 0 then total / cast(violent as double) else 0 end')}
    as total_per_violent"""

SEASONS = """case when week between 22 and 35 then 1 else 0 end as is_summer,
  case when week >= 48 or week <= 9 then 1 else 0 end as is_winter,
  case when week >= 47 or week <= 2 then 1 else 0 end as is_holiday_season"""

TREND = r(
    "case when total_lag_1 > 0 then (total - total_lag_1) / cast(total_lag_1 as double) else 0 end"
) + " as trend"


def lag(col: str, k: int, keys: str = "unit") -> str:
    w = f"(partition by {keys} order by year, week)"
    return f"lag({col}, {k}, 0) over {w} as {col}_lag_{k}"


def rolling(col: str, size: int) -> str:
    w = f"(partition by unit order by year, week rows between {size} preceding and 1 preceding)"
    return f"coalesce(avg(cast({col} as double)) over {w}, 0) as {col}_mean_{size}"


def label(keys: str = "unit") -> str:
    return f"lead(violent) over (partition by {keys} order by year, week) as label"


LAGS = ", ".join([*(lag("total", k) for k in (1, 2, 3)), *(lag("violent", k) for k in (1, 2))])
MEANS = ", ".join([rolling("total", 3), rolling("violent", 3), rolling("total", 4)])
LAG_NAMES = "total_lag_1, total_lag_2, total_lag_3, violent_lag_1, violent_lag_2"
MEAN_NAMES = ", ".join(f"{r(c)} as {c}" for c in ("total_mean_3", "violent_mean_3", "total_mean_4"))


def full(source: str, frame: str = "panel") -> str:
    """Features in two steps: drop the unlabelled row, then number the rest."""
    return f"""{source}, stepped as (
      select *, {LAGS}, {MEANS}, {label()} from {frame}), labelled as (
      select *, {small('row_number() over (partition by unit order by year, week) - 1')}
        as time_index
      from stepped where label is not null)"""


def features(source: str, frame: str = "panel") -> str:
    return f"""with {full(source, frame)}
      select unit, year, week, total, violent, {RATES}, {LAG_NAMES}, {MEAN_NAMES},
        label, time_index, {SHARES}, {SEASONS}, {TREND}
      from labelled"""


# The persistence forecast repeats this week's count.
BASE = f"""{panel('unit, district')}, stepped as (
  select *, {lag('total', 1, 'unit, district')}, {label('unit, district')} from panel), base as (
  select *,
    {small('row_number() over (partition by unit, district order by year, week) - 1')}
      as time_index,
    case when district is null then 'Unknown' when district <= 8 then 'North'
      when district <= 16 then 'Central' else 'South' end as band,
    cast(violent as double) as prediction
  from stepped where label is not null)"""

DATED_SPLIT = """cut as (
  select min(monday) + to_days(cast(floor(date_diff('day', min(monday), max(monday))
    * cast(0.8 as double)) as integer)) as cutoff from dated)"""


def fairness(keys: str, prediction: str = "prediction") -> str:
    return f"""{keys}, {N}, {r('avg(label)')} as actual_avg,
      {r(f'avg({prediction})')} as predicted_avg,
      {r(f'avg(abs({prediction} - label))')} as mae,
      {r(f'avg({prediction} - label)')} as mean_error"""


# --- places and eras --------------------------------------------------------


def correlation(same_prefix: bool) -> str:
    rule = "and left(a.unit, length(a.unit) - 2) = left(b.unit, length(b.unit) - 2)"
    years = ", ".join(f"({y})" for y in YEARS)
    return f"""with {ORDERS}, counted as (
      select unit, year(ts) as year, count(*) as n from inc group by 1, 2), cells as (
      select u.unit, y.year, cast(coalesce(c.n, 0) as double) as n
      from (select distinct unit from counted where year >= {min(YEARS)}) u
      cross join (values {years}) y(year)
      left join counted c on c.unit = u.unit and c.year = y.year)
      select a.unit as u1, b.unit as u2,
        case when stddev_pop(a.n) > 0 and stddev_pop(b.n) > 0
          then {r('covar_pop(a.n, b.n) / (stddev_pop(a.n) * stddev_pop(b.n))', 9)} end as r
      from cells a join cells b on a.year = b.year and a.unit < b.unit
        {rule if same_prefix else ''}
      group by 1, 2"""


YEAR_COUNTS = ", ".join(f"count(*) filter (where year(ts) = {y})" for y in YEARS)
# Profiles of customers: yearly counts shifted to mean 0 and scaled to length 1.
STRONG_PAIRS = f"""with {ORDERS}, c as (
    select block, [{YEAR_COUNTS}] as n from inc where year(ts) >= {min(YEARS)} group by 1), d as (
    select block, list_transform(n, lambda x: x - list_sum(n) / cast(len(n) as double)) as d from c), z as (
    select block, list_transform(d, lambda x: x / sqrt(list_dot_product(d, d))) as z
    from d where list_max(d) > list_min(d)), p as (
    select a.block as u1, b.block as u2,
      {r('greatest(-1, least(1, list_dot_product(a.z, b.z)))', 6)} as r
    from z a join z b on a.block < b.block)
    select u1, u2, r from p where abs(r) >= 0.99"""


def t_test(table: str, by: str = "", digits: int = 4) -> str:
    """Paired test of a and b; p by the closed form for whole degrees of freedom."""
    # Products of even over odd numbers, or of odd over even ones, times powers of the cosine.
    term = """list_sum(list_transform(range({0}), lambda k: coalesce(list_product(list_transform(range(1, k + 1),
      lambda j: (2 * j - {1}) / cast(2 * j + 1 - {1} as double) * cos_ * cos_)), 1)))"""
    odd, even = term.format("cast((df - 1) // 2 as bigint)", 0), term.format("cast(df // 2 as bigint)", 1)
    keys = f"{by}, " if by else ""
    return f"""s as (
      select {keys}{N}, avg(a - b) as mean_diff,
        avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) as t, {big('count(*) - 1')} as df
      from {table} {'group by ' + by if by else ''}), x as (
      select *, atan(abs(t) / sqrt(df)) as th, cos(atan(abs(t) / sqrt(df))) as cos_ from s)
      select {keys}n, {r('mean_diff', digits)} as mean_diff, {r('t', digits)} as t, df,
        {r(f"1 - case when df % 2 = 1 then 2 / pi() * (th + sin(th) * cos_ * coalesce({odd}, 0)) else sin(th) * {even} end", digits)} as p
      from x"""


ERA = "case when year(ts) <= 1998 then 'early' else 'late' end"
MEANS_OF_ERAS = f"""{ORDERS}, means as (
  select district, count(*) filter (where year(ts) between 1995 and 1998) / cast(4 as double)
    as early, count(*) filter (where year(ts) between 1999 and 2001) / cast(3 as double) as late
  from inc group by 1)"""


# --- summary ----------------------------------------------------------------


def report(source: str, since: int) -> str:
    def best(bucket: str, table: str, key: str = "n", order: str = "desc") -> str:
        return f"(select {bucket} from {table} order by {key} {order}, 1 limit 1)"

    def of(column: str, table: str, where: str) -> str:
        return f"(select {column} from {table} where {where})"

    first, last = "(select min(b) from y)", "(select max(b) from y)"
    first_n, last_n = of("n", "y", f"b = {first}"), of("n", "y", f"b = {last}")
    return f"""with {source},
      t as (select {big('count(*)')} as n, {HITS} as v from inc),
      m as (select {MONTH} as b, {N} from inc group by 1),
      h as (select {HOUR} as b, {N}, 100 * sum(violent) / cast(count(*) as double) as share
        from inc group by 1),
      d as (select {DOW} as b, {N} from inc group by 1),
      y as (select {YEAR} as b, {N} from inc where year(ts) >= {since} group by 1),
      c as (select category as b, {N} from inc group by 1),
      report as (select t.n as total_n, t.v as violent_n,
        {best('b', 'm')} as peak_month, (select max(n) from m) as peak_month_n,
        {best('b', 'h')} as peak_hour, (select max(n) from h) as peak_hour_n,
        {best('b', 'd')} as peak_dow, (select max(n) from d) as peak_dow_n,
        {best('b', 'c')} as top_category, (select max(n) from c) as top_category_n,
        {first} as first_year, {first_n} as first_year_n,
        {last} as last_year, {last_n} as last_year_n,
        {best('b', 'h', 'share')} as high_hour, (select max(share) from h) as high_hour_pct,
        {best('b', 'h', 'share', 'asc')} as low_hour, (select min(share) from h) as low_hour_pct,
        t.n - t.v as non_violent_n,
        100 * t.v / cast(t.n as double) as violent_pct,
        100 * (t.n - t.v) / cast(t.n as double) as non_violent_pct,
        100 * (select max(n) from c) / cast(t.n as double) as top_category_pct,
        100 * ({last_n} - {first_n}) / cast({first_n} as double) as change_pct
      from t)"""


PCTS = ("high_hour_pct", "low_hour_pct", "violent_pct", "non_violent_pct", "top_category_pct",
        "change_pct")
ROUND_REPORT = f"""select * replace ({', '.join(f'{r(c)} as {c}' for c in PCTS)}) from report"""

MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
DAYS = "['Sun','Mon','Tue','Wed','Thu','Fri','Sat']"


def report_lines() -> str:
    def thousands(c: str) -> str:
        return f"format('{{:,}}', {c})"

    def percent(c: str) -> str:
        return f"printf('%.2f%%', {c})"

    def clock(c: str) -> str:
        return f"printf('%02d:00', {c})"

    lines = (
        ("Incidents", [thousands("total_n")]),
        ("Violent", [thousands("violent_n"), percent("violent_pct")]),
        ("Non-violent", [thousands("non_violent_n"), percent("non_violent_pct")]),
        ("Peak month", [f"{MONTHS}[peak_month]", thousands("peak_month_n")]),
        ("Peak hour", [clock("peak_hour"), thousands("peak_hour_n")]),
        ("Peak weekday", [f"{DAYS}[peak_dow]", thousands("peak_dow_n")]),
        (
            "Most common category",
            ["top_category", thousands("top_category_n"), percent("top_category_pct")],
        ),
        ("First year", ["cast(first_year as varchar)", thousands("first_year_n")]),
        ("Last year", ["cast(last_year as varchar)", thousands("last_year_n")]),
        ("Change", [percent("change_pct")]),
        ("Highest violent share", [clock("high_hour"), percent("high_hour_pct")]),
        ("Lowest violent share", [clock("low_hour"), percent("low_hour_pct")]),
    )
    shown = ", ".join(
        f"'{title}: ' || " + " || ', ' || ".join(parts) for title, parts in lines
    )
    return f"{report(EVENTS, 2001)} select unnest([{shown}]) as value from report"


TYPED = "select id, ts, block, unit, district, category, violent, arrest, domestic from inc"


def rates(flag: str) -> str:
    return f"""with {ORDERS} select district, {N}, {big(f'sum({flag})')} as {flag}_n,
      {r(f'100 * sum({flag}) / cast(count(*) as double)')} as {flag}_pct
      from inc group by district"""


DIRTY = ORDERS.replace("inc as (", "whole as (", 1) + """, inc as (
  select id, case when id % 11 <> 0 and id % 13 <> 0 then ts end as ts,
    case when id % 47 = 0 then null when id % 53 = 0 then '' else block end as block,
    case when id % 61 <> 0 then unit end as unit,
    case when id % 23 <> 0 and id % 29 <> 0 and id % 31 <> 0 and id % 37 <> 0 and id % 41 <> 0
      then district end as district,
    case when id % 43 <> 0 then category end as category,
    case when id % 43 <> 0 then violent end as violent,
    case when id % 17 <> 0 and id % 19 <> 0 then arrest end as arrest,
    case when id % 59 <> 0 then domestic end as domestic
  from whole)"""
DIRTY_PANEL = f"""{DIRTY}{panel('unit, district')[len(ORDERS):]
    .replace('as violent', 'as violent_').replace('avg(', 'coalesce(avg(').replace('double))', 'double)), 0)')
    .replace('from inc', 'from dated').replace(', panel as (', ', dated as (select * from inc where ts is not null), counted as (')},
  panel as (select * exclude (violent_), coalesce(violent_, 0) as violent from counted)"""

# Week keys of every day between the first incident and the last, numbered.
CALENDAR_WEEKS = f"""{panel(year='year(ts)')}, days as (
  select cast(unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)), interval 1 day))
    as date) as day from inc), keys as (
  select {small('year(day)')} as year, {small('week(day)')} as week,
    cast(min(date_trunc('week', day)) as date) as monday,
    row_number() over (order by year(day), week(day)) as position
  from days group by year(day), week(day)), dated as (
  select p.*, k.monday, k.position from panel p join keys k on p.year = k.year and p.week = k.week)"""

# The 16 scalar inputs of the full forecast, in their order.
TABLE_VALUES = """[cast(x as double) for x in [total, arrest_rate, domestic_rate, total_per_violent,
  total_lag_1, total_lag_2, total_lag_3, violent_lag_1, violent_lag_2, total_mean_3,
  violent_mean_3, total_mean_4, is_summer, is_winter, is_holiday_season, trend]] as vals"""

ERROR = f"""{BASE}, e as (select band, prediction - label as err from base), q as (
  select band, count(*) as n, min(err) as min, quantile_cont(err, 0.25) as q1,
    quantile_cont(err, 0.5) as median, quantile_cont(err, 0.75) as q3, max(err) as max
  from e group by band)"""
INSIDE = "err between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"

ORACLE: dict[str, str] = {
    "arrests_by_month": profile(ORDERS, "month", MONTH, where="arrest = 1"),
    "arrests_by_hour": profile(EVENTS, "hour", HOUR, where="arrest = 1"),
    "arrests_by_dow": profile(ORDERS, "dow", DOW, where="arrest = 1"),
    "arrests_by_year_month": f"""with {ORDERS} select {YEAR} as year, {MONTH} as month, {N}
      from inc where arrest = 1 group by 1, 2""",
    "arrest_rate_by_month": profile(
        ORDERS,
        "month",
        MONTH,
        f""", {big('sum(arrest)')} as arrest_n,
        {r('100 * sum(arrest) / cast(count(*) as double)')} as arrest_pct""",
    ),
    "counts_by_district": profile(ORDERS, "district", "district"),
    "top_categories": f"""with {ORDERS} select category, {N} from inc
      group by 1 order by n desc, category limit 15""",
    "monthly_violent": profile(
        ORDERS,
        "month",
        MONTH,
        f", {HITS} as violent_n, {big('count(*) - sum(violent)')} as non_violent_n",
    ),
    "hourly_violent": profile(EVENTS, "hour", HOUR, f", {HITS} as violent_n"),
    "dow_violent": profile(ORDERS, "dow", DOW, f", {HITS} as violent_n"),
    "yearly_violent": profile(
        ORDERS, "year", YEAR, f", {HITS} as violent_n", "year(ts) >= 1995"
    ),
    "hourly_violent_pct": profile(
        EVENTS,
        "hour",
        HOUR,
        f""", {HITS} as violent_n,
        {r('100 * sum(violent) / cast(count(*) as double)')} as violent_pct""",
    ),
    "hourly_violent_pct_mean": f"""with {EVENTS}, h as (
      select hour(ts) as hour, count(*) as n, sum(violent) as v from inc group by 1)
      select {r('avg(100 * v / cast(n as double))')} as mean_pct,
        {r('100 * sum(v) / cast(sum(n) as double)')} as pooled_pct from h""",
    "overall_summary": f"""with {ORDERS} select {big('count(*)')} as total_n,
      {HITS} as violent_n, {big('count(*) - sum(violent)')} as non_violent_n,
      {r('100 * sum(violent) / cast(count(*) as double)')} as violent_pct,
      {r('100 * (count(*) - sum(violent)) / cast(count(*) as double)')} as non_violent_pct
      from inc""",
    "peak_buckets": f"""with {EVENTS}, b as (
      select 'month' as period, {MONTH} as bucket, {N} from inc group by 2
      union all select 'hour', {HOUR}, {N} from inc group by 2
      union all select 'dow', {DOW}, {N} from inc group by 2)
      select period, bucket, n from b
      qualify row_number() over (partition by period order by n desc, bucket) = 1""",
    "violent_pct_extremes": f"""with {EVENTS}, h as (
      select {HOUR} as hour, 100 * sum(violent) / cast(count(*) as double) as p
      from inc group by 1)
      select (select hour from h order by p desc, hour limit 1) as high_hour,
        {r('max(p)')} as high_pct,
        (select hour from h order by p, hour limit 1) as low_hour, {r('min(p)')} as low_pct
      from h""",
    "top_category_share": f"""with {ORDERS} select category, {N},
      {big('(select count(*) from inc)')} as total_n,
      {r('100 * count(*) / cast((select count(*) from inc) as double)')} as share_pct
      from inc group by category order by n desc, category limit 1""",
    "yearly_change": f"""with {ORDERS}, y as (
      select {YEAR} as year, {N} from inc where year(ts) >= 1995 group by 1), e as (
      select min(year) as first_year, arg_min(n, year) as first_year_n,
        max(year) as last_year, arg_max(n, year) as last_year_n from y)
      select *, {r('100 * (last_year_n - first_year_n) / cast(first_year_n as double)')}
        as change_pct from e""",
    "summary_report": f"{report(ORDERS, 1995)} {ROUND_REPORT}",
    "summary_report_events": f"{report(EVENTS, 2001)} {ROUND_REPORT}",
    "hotspots_top10": f"""with {ORDERS} select block, {N} from inc
      where year(ts) >= 1999 group by 1 order by n desc, block limit 10""",
    "unit_year_counts": f"""with {ORDERS} select unit, {YEAR} as year, {N}
      from inc where year(ts) >= 1995 group by 1, 2""",
    "unit_year_matrix": f"""with {ORDERS} select unit, """
    + ", ".join(f"{big(f'count(*) filter (where year(ts) = {y})')} as y{y}" for y in YEARS)
    + " from inc where year(ts) >= 1995 group by 1",
    "pair_correlation": correlation(same_prefix=True),
    "pair_correlation_full": correlation(same_prefix=False),
    "strong_pairs": STRONG_PAIRS,
    "hierarchy_counts": f"""with {ORDERS} select district, unit, block, {N},
      {small('3 - grouping(district) - grouping(unit) - grouping(block)')} as level
      from inc group by rollup (district, unit, block)""",
    "era_counts": f"""with {ORDERS} select district, {ERA} as era, {N}
      from inc where year(ts) between 1995 and 2001 group by 1, 2""",
    "era_means": f"""with {MEANS_OF_ERAS}
      select district, {r('early')} as early, {r('late')} as late from means""",
    "era_counts_many": f"""with {ORDERS}, e as (
      select n_name as era, case when n_nationkey % 7 <> 0 then 1992 + n_nationkey % 8 else 0 end as first_,
        case when n_nationkey % 5 <> 0 then 1992 + n_nationkey % 8 + n_nationkey % 4 else 9999 end as last_
      from nation)
      select district, era, {N} from inc join e on year(ts) between first_ and last_ group by 1, 2""",
    "paired_t": f"with {MEANS_OF_ERAS}, ab as (select early as a, late as b from means), {t_test('ab')}",
    "paired_t_by_category": f"""with {ORDERS}, ab as (
      select category, district, count(*) filter (where year(ts) between 1995 and 1996) as a,
        count(*) filter (where year(ts) between 1997 and 1998) as b
      from inc group by 1, 2), {t_test('ab', 'category', 9)}""",
    "tsv_roundtrip": f"""with {ORDERS} select unit, {YEAR} as year, {N} from inc
      where year(ts) >= 1995 group by 1, 2""",
    "csv_roundtrip": f"with {ORDERS} {TYPED}",
    "csv_mixed_headers": f"""with {ORDERS} {TYPED.replace('domestic from', 'case when id % 3 < 2 then domestic end as domestic from')}""",
    "malformed_rows": f"""with {ORDERS}
      select id, case when good then unit end as unit, case when good then district end as district,
        case when id % 97 = 0 then 'too few fields' when id % 89 = 0 then 'too many fields' else '' end as reason,
        {small('case when id % 97 = 0 then 5 when id % 89 = 0 then 9 else 8 end')} as fields
      from (select *, id % 97 <> 0 and id % 89 <> 0 as good from inc)""",
    "parquet_roundtrip": f"""with {ORDERS} {TYPED.replace(' from inc', f', {YEAR} as year from inc')}""",
    "text_roundtrip": report_lines(),
    "clean_text_fields": f"with {ORDERS} {TYPED}",
    "violent_flags": """select o_orderkey as id,
      case when o_orderpriority = '5-LOW' then null
        when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as flag_or_null,
      case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 else 0 end as flag_or_zero
      from orders""",
    "clean_dirty_fields": f"with {DIRTY} {TYPED}",
    "arrests_by_month_undated": profile(DIRTY, "month", MONTH, where="arrest = 1"),
    "monthly_violent_dirty": profile(
        DIRTY,
        "month",
        MONTH,
        f", {big('sum(coalesce(violent, 0))')} as violent_n, {big('count(*) - sum(coalesce(violent, 0))')} as non_violent_n",
        "ts is not null",
    ),
    "counts_by_district_dirty": profile(DIRTY, "district", "district", where="district is not null"),
    "hotspots_dirty": f"""with {DIRTY} select block, {N} from inc
      where year(ts) >= 1999 and block <> '' group by 1 order by n desc, block limit 10""",
    "panel_dirty": f"""with {DIRTY_PANEL}
      select unit, district, year, week, total, violent, {r('arrest_rate')} as arrest_rate,
        {r('domestic_rate')} as domestic_rate from panel""",
    "fairness_unknown_band": f"""with {DIRTY_PANEL}{BASE[len(panel('unit, district')):]}
      select {fairness('band')} from base group by band""",
    "weekly_panel": f"""with {panel()}
      select unit, year, week, total, violent, {RATES} from panel""",
    "weekly_panel_calendar": f"""with {panel(year='year(ts)')}
      select unit, year, week, total, violent, {RATES} from panel""",
    "weekly_panel_district": f"""with {panel('unit, district')}
      select unit, district, year, week, total, violent, {RATES} from panel""",
    "panel_lags": f"with {panel()} select unit, year, week, {LAGS} from panel",
    "panel_rolling": f"""with {panel()}, p as (select *, {MEANS} from panel)
      select unit, year, week, {MEAN_NAMES} from p""",
    "panel_label": f"""with {panel()}, p as (select *, {label()} from panel)
      select unit, year, week, label from p where label is not null""",
    "panel_flags_trend": f"""with {panel()}, p as (select *, {lag('total', 1)} from panel)
      select unit, year, week, {SEASONS}, {TREND} from p""",
    "panel_shares": f"with {panel()} select unit, year, week, {SHARES} from panel",
    "panel_dense": f"""with {DENSE}
      select unit, year, week, total, violent, {RATES} from dense""",
    "panel_dense_calendar": f"""with {CALENDAR_WEEKS}, spans as (
      select unit, min(position) as first_, max(position) as last_ from dated group by 1)
      select s.unit, k.year, k.week, coalesce(d.total, 0) as total, coalesce(d.violent, 0) as violent,
        {r('coalesce(d.arrest_rate, 0)')} as arrest_rate, {r('coalesce(d.domestic_rate, 0)')} as domestic_rate,
        k.monday
      from spans s join keys k on k.position between s.first_ and s.last_
      left join dated d on d.unit = s.unit and d.position = k.position""",
    "panel_split_calendar": f"""with {full(CALENDAR_WEEKS, 'dated').replace('dated as (', 'weeks as (', 1).replace('from dated)', 'from weeks)')},
      dated as (select * from labelled), {DATED_SPLIT}
      select unit, year, week, label, time_index,
        case when monday <= cutoff then 'train' else 'test' end as split
      from dated, cut""",
    "panel_split": f"""with {full(panel())}, cut as (
      select floor(max(time_index) * cast(0.8 as double)) as cutoff from labelled)
      select unit, year, week, label, time_index,
        case when time_index <= cutoff then 'train' else 'test' end as split
      from labelled, cut""",
    "panel_split_by_date": f"""with {full(panel())}, dated as (
      select *, date_trunc('week', make_date(year, 1, 4)) + to_days((week - 1) * 7) as monday
      from labelled), {DATED_SPLIT}
      select unit, year, week, label, time_index,
        case when monday <= cutoff then 'train' else 'test' end as split
      from dated, cut""",
    "features_full": features(panel()),
    "features_full_calendar": features(panel(year="year(ts)")),
    "features_full_dense": features(DENSE, "dense"),
    "features_base": f"""with {BASE}
      select unit, district, year, week, total, violent, {RATES}, total_lag_1,
        label, time_index, {SHARES}, band
      from base""",
    "category_index": f"""with {panel()}, v as (
      select 'unit' as "column", unit as value, {N} from panel group by 2
      union all select 'year', cast(year as varchar), {N} from panel group by 2
      union all select 'week', cast(week as varchar), {N} from panel group by 2)
      select "column", value,
        {small('row_number() over (partition by "column" order by n desc, value) - 1')}
          as "index", n
      from v""",
    "feature_slots": f"""with {full(panel())}, cut as (
      select floor(max(time_index) * cast(0.8 as double)) as cutoff from labelled), r as (
      select unit, year, week, time_index <= cutoff as train, {TABLE_VALUES}
      from (select unit, year, week, total, violent, {RATES}, {LAG_NAMES}, {MEAN_NAMES},
          time_index, {SHARES}, {SEASONS}, {TREND} from labelled), cut), v as (
      select 0 as c, unit as value, count(*) as n from r where train group by 2
      union all select 1, cast(year as varchar), count(*) from r where train group by 2
      union all select 2, cast(week as varchar), count(*) from r where train group by 2), d as (
      select *, row_number() over (order by c, n desc, value) - 1 as slot from v), s as (
      select unit, year, week, slot, cast(1 as double) as value
      from r join d on d.value = case d.c when 0 then unit when 1 then cast(year as varchar)
        else cast(week as varchar) end
      union all
      select unit, year, week, (select count(*) from d) + i - 1, vals[i]
      from r, unnest(range(1, 17)) x(i))
      select unit, year, week, {small('slot')} as slot, value from s where value <> 0""",
    "gbt_table_parity": f"""with {full(PANEL_OF_DISTRICTS)}, cut as (
      select floor(max(time_index) * cast(0.8 as double)) as cutoff from labelled)
      select unit, {N}, {big('sum(label)')} as label_sum, {big('0')} as nulls, {big('0')} as mismatches
      from labelled, cut where time_index > cutoff group by unit""",
    "oof_calibration": f"""with {panel('unit, district').replace(
        "from inc group by",
        "from (select * replace (lpad(cast(district as varchar), 2, '0') as unit) from inc) group by",
    )}{BASE[len(panel('unit, district')):]}
      select band, {N}, {r('avg(label)')} as actual_avg, {r('avg(label)')} as calibrated_avg,
        {r('0')} as mean_error from base group by band""",
    "metrics_report": f"""with {BASE}, s as (
      select avg((label - prediction) * (label - prediction)) as mse,
        avg(abs(label - prediction)) as mae, var_pop(label) as spread from base)
      select printf('RMSE: %.4f', sqrt(mse)) || chr(10) || printf('MAE: %.4f', mae) || chr(10)
        || printf('MSE: %.4f', mse) || chr(10) || printf('R2: %.4f', 1 - mse / spread) as value from s""",
    "persistence_metrics": f"""with {BASE}, s as (
      select {N}, avg((label - prediction) * (label - prediction)) as mse,
        avg(abs(label - prediction)) as mae, var_pop(label) as spread from base)
      select n, {r('sqrt(mse)')} as rmse, {r('mae')} as mae, {r('mse')} as mse,
        {r('1 - mse / spread')} as r2 from s""",
    "arrest_rate_by_district": rates("arrest"),
    "violent_rate_by_district": rates("violent"),
    "arrest_rate_top5": f"select * from ({rates('arrest')}) order by arrest_pct desc, district limit 5",
    "violent_rate_top5": f"select * from ({rates('violent')}) order by violent_pct desc, district limit 5",
    "fairness_by_band": f"with {BASE} select {fairness('band')} from base group by band",
    "fairness_by_year": f"""with {BASE} select {fairness('band, year')} from base
      group by band, year""",
    "fairness_by_domestic": f"""with {BASE}, g as (
      select *, case when domestic_rate is null then 'Unknown' when domestic_rate <= 0 then 'none'
        when domestic_rate <= 0.5 then 'some' else 'most' end as domestic_band from base)
      select {fairness('domestic_band')} from g group by domestic_band""",
    "disparity": f"""with {BASE}, f as (
      select avg(prediction) as p, avg(prediction - label) as e from base group by band)
      select {big('count(*)')} as groups, {r('min(p) / max(p)')} as impact_ratio,
        {r('max(e) - min(e)')} as error_gap, min(p) / max(p) < 0.8 as flagged from f""",
    "error_quartiles": f"""with {ERROR}
      select e.band, {big('n')} as n, {r('min')} as min, {r('q1')} as q1,
        {r('median')} as median, {r('q3')} as q3, {r('max')} as max,
        {r(f'min(err) filter (where {INSIDE})')} as whisker_low,
        {r(f'max(err) filter (where {INSIDE})')} as whisker_high,
        {big(f'count(*) filter (where not ({INSIDE}))')} as outliers
      from e join q on e.band = q.band group by e.band, n, min, q1, median, q3, max""",
    "actual_vs_predicted": f"""with {BASE} select band, {big('label')} as actual_bin,
      {big('prediction')} as predicted_bin, {N},
      {big('(select max(label) from base)')} as diagonal_end
      from base group by band, label, prediction""",
    "group_weights": f"""with {BASE}, c as (select band, {N} from base group by 1)
      select band, n, {r('(select sum(n) from c) / cast((select count(*) from c) * n as double)')}
        as weight from c""",
    "calibrated_errors": f"""with {BASE}, dated as (
      select *, date_trunc('week', make_date(year, 1, 4)) + to_days((week - 1) * 7) as monday
      from base), {DATED_SPLIT}, o as (
      select band, avg(prediction - label) as offset_ from dated, cut
      where monday <= cutoff group by 1), s as (
      select d.band, d.label, d.prediction - coalesce(o.offset_, 0) as calibrated
      from dated d cross join cut left join o on d.band = o.band where monday > cutoff)
      select {fairness('band', 'calibrated')} from s group by band""",
}
