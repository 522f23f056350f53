"""The seven source shapes, derived from the driver's TPC-H-style tables.

The test data has no subscription-marketplace tables, so each source is a
deterministic projection of ``customer``, ``supplier``, ``orders`` or
``events``: integer arithmetic on keys, a division for the commission rate,
string concatenation, ``case``, casts and date-plus-days.  Everything is a
narrow (map-only) projection: no shuffle, columns pruned at the parquet scan.
Dates are emitted as ISO text, with '' for "missing", exactly like the CSV
seeds, so the staging layer does the same cleaning work on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiloom.sources.schemas import SOURCE_SCHEMAS

# Market code by key modulo 6.
MARKETS = ["DK", "NO", "SE", "DE", "NL", "US"]


def _market(key: str) -> str:
    labels = ", ".join(f"'{m}'" for m in MARKETS)
    return f"element_at(array({labels}), cast(({key}) % 6 + 1 as int))"


def _pick(index: str, labels) -> str:
    quoted = ", ".join(f"'{v}'" for v in labels)
    return f"element_at(array({quoted}), cast({index} + 1 as int))"


def _day(base: str, offset: str) -> str:
    """``base + offset`` days, as ISO text (``base`` a date literal or expression)."""
    start = f"date'{base}'" if base[0].isdigit() else base
    return f"cast(date_add({start}, cast({offset} as int)) as string)"


def _project(df: DataFrame, name: str, exprs: dict) -> DataFrame:
    """One projection of SQL expressions, cast to the declared source schema."""
    types = {f.name: f.dataType.simpleString() for f in SOURCE_SCHEMAS[name].fields}
    return df.selectExpr(*[f"cast({exprs[c]} as {types[c]}) as {c}" for c in types])


def customers(customer: DataFrame) -> DataFrame:
    return _project(customer, "customers", {
        "customer_id": "concat('C', c_custkey)",
        "customer_name": "c_name",
        "country": _market("c_custkey"),
        "segment": "case when c_mktsegment in ('AUTOMOBILE', 'BUILDING') then 'SMB' "
                   "when c_mktsegment in ('FURNITURE', 'MACHINERY') then 'MID' else 'ENT' end",
        "signup_date": _day("2019-01-01", "c_custkey * 37 % 1910"),
        "plan_type": "case when c_acctbal < 3000 then 'basic' "
                     "when c_acctbal < 7000 then 'premium' else 'enterprise' end",
        "monthly_revenue": "500 + (c_custkey % 97) * 60",
        # most partners have customers, some customers name a partner that is not there
        "partner_id": "case when c_custkey % 5 != 0 then concat('P', "
                      "if(c_custkey % 3 = 0, c_custkey % 1009, c_custkey % 113)) end",
    })


def subscriptions(orders: DataFrame) -> DataFrame:
    ended = _day("2019-06-01", "o_orderkey * 13 % 1750 + 60 + o_orderkey % 200")
    return _project(orders, "subscriptions", {
        "subscription_id": "concat('S', o_orderkey)",
        "customer_id": "concat('C', o_custkey)",
        "plan_type": _pick("o_orderkey % 7 % 3", ["basic", "premium", "enterprise"]),
        "start_date": _day("2019-06-01", "o_orderkey * 13 % 1750"),
        "end_date": f"case when o_orderstatus = 'F' or (o_orderstatus = 'P' and "
                    f"o_orderkey % 4 = 1) then {ended} else '' end",
        "churn_date": f"case when o_orderstatus = 'F' then {ended} else '' end",
        "churn_reason": "case when o_orderstatus = 'F' then "
                        + _pick("o_orderkey % 3", ["price_too_high", "competitor", "not_using"])
                        + " else ' ' end",
        "mrr": "500 + (o_orderkey % 41) * 50",
        "country": _market("o_custkey"),
    })


# shared by the three event-derived sources
_EVENT_DAY_SHIFT = "event_id % 5 % 3 * 30"


def _event_day(offset: str) -> str:
    return _day("cast(ts as date)", offset)


def leads(events: DataFrame) -> DataFrame:
    key = "(user_id * 10 + event_id % 10)"
    s, q = _EVENT_DAY_SHIFT, "(event_id * 31 % 100)"
    return _project(events.filter("event_type in ('click', 'error', 'signup')"), "leads", {
        "lead_id": "concat('L', event_id)",
        "customer_id": f"case when event_id % 61 != 0 then concat('C', {key}) end",
        "country": _market(key),
        "service_type": _pick("event_id % 11 % 4",
                              ["accounting", "tax_advisory", "bookkeeping", "audit"]),
        "lead_date": _event_day(s),
        "assigned_at": f"case when {q} between 70 and 79 then '' "
                       f"else {_event_day(f'{s} + event_id % 13 % 4')} end",
        "converted_at": f"case when {q} < 50 then {_event_day(f'{s} + 5 + event_id % 7')} "
                        "else '' end",
        "lead_status": f"case when {q} < 50 then 'converted' when {q} < 70 then 'pending' "
                       f"when {q} < 80 then ' unassigned' else 'lost' end",
        "lead_source": _pick("event_id % 17 % 3", ["organic", "paid", "partner"]),
    })


def invoices(orders: DataFrame) -> DataFrame:
    i = "(o_orderkey % 300)"
    return _project(orders, "invoices", {
        "invoice_id": "concat('INV', o_orderkey)",
        # some without a customer, some of a customer that is not there
        "customer_id": "case when o_orderkey % 53 = 0 then null "
                       "when o_orderkey % 59 = 0 then concat('C', o_custkey + 900000000) "
                       "else concat('C', o_custkey) end",
        "issue_date": _day("2023-06-01", i),
        "due_date": _day("2023-06-01", f"{i} + 30"),
        "paid_date": f"case when o_orderstatus = 'F' then "
                     f"{_day('2023-06-01', f'{i} + 30 - o_orderkey % 10')} "
                     f"when o_orderstatus = 'P' then "
                     f"{_day('2023-06-01', f'{i} + 31 + o_orderkey % 40')} else '' end",
        "amount": "floor(o_totalprice)",
        "currency": "case o_custkey % 6 when 0 then 'DKK' when 1 then 'NOK' when 2 then 'SEK' "
                    "when 5 then 'USD' else 'EUR' end",
        "status": "case o_orderstatus when 'F' then 'paid' when 'P' then 'paid_late' "
                  "when 'O' then 'overdue' end",
        "country": _market("o_custkey"),
    })


def partners(supplier: DataFrame) -> DataFrame:
    return _project(supplier, "partners", {
        "partner_id": "concat('P', s_suppkey)",
        "partner_name": "s_name",
        "country": _market("s_suppkey"),
        "partner_type": "'accounting_firm'",
        "contract_start_date": _day("2017-01-01", "s_suppkey * 29 % 2500"),
        "monthly_fee": "10000 + (s_suppkey % 13) * 1000",
        "commission_rate": "cast(500000 + s_suppkey % 10 * 100000 + s_suppkey % 7 as double) / 10000000",
        "status": "case when s_suppkey % 9 = 8 then 'inactive' else 'active' end",
    })


def nps_surveys(events: DataFrame) -> DataFrame:
    key = "(user_id * 10 + event_id % 7)"
    return _project(events.filter("event_type = 'view'"), "nps_surveys", {
        "survey_id": "concat('SV', event_id)",
        "customer_id": f"case when event_id % 67 != 0 then concat('C', {key}) end",
        "survey_date": _event_day(_EVENT_DAY_SHIFT),
        "nps_score": "event_id % 11",
        "csat_score": "1 + event_id % 5",
        "country": _market(key),
        "comment": "concat('comment ', event_id)",
    })


def upsell_events(events: DataFrame) -> DataFrame:
    key = "(user_id * 10 + event_id % 10)"
    return _project(events.filter("event_type = 'purchase'"), "upsell_events", {
        "upsell_id": "concat('U', event_id)",
        "customer_id": f"concat('C', {key})",
        "upsell_date": _event_day(_EVENT_DAY_SHIFT),
        "from_plan": "case when event_id % 3 = 0 then 'basic' else 'premium' end",
        "to_plan": "case when event_id % 4 = 3 then 'enterprise' else 'premium' end",
        "add_on": "case when event_id % 7 < 4 then 'tax_advisory_add_on' else ' ' end",
        "add_on_revenue": "case when event_id % 13 != 0 then 300 + (event_id % 23) * 50 end",
        "sales_rep": "concat('SR0', 1 + event_id % 4)",
        "country": _market(key),
    })


_BUILDERS = {
    "customers": ("customer", customers),
    "subscriptions": ("orders", subscriptions),
    "leads": ("events", leads),
    "invoices": ("orders", invoices),
    "partners": ("supplier", partners),
    "nps_surveys": ("events", nps_surveys),
    "upsell_events": ("events", upsell_events),
}


def load_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source frame derived from the driver table under ``sf_dir``."""
    table, build = _BUILDERS[name]
    return build(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def load_sources(spark: SparkSession, sf_dir: str) -> dict:
    """All seven source frames (lazy; each is a pruned parquet scan)."""
    return {name: load_source(spark, sf_dir, name) for name in _BUILDERS}


def load_skewed_sources(spark: SparkSession, sf_dir: str) -> dict:
    """The sources with one hot customer: it has every 200th subscription and invoice and
    every 50th survey, next to customers with a few rows each."""
    out = load_sources(spark, sf_dir)
    for name, key, every in (("subscriptions", "substr(subscription_id, 2)", 200),
                             ("invoices", "substr(invoice_id, 4)", 200),
                             ("nps_surveys", "substr(survey_id, 3)", 50)):
        hot = f"if(cast({key} as bigint) % {every} = 1, 'C1', customer_id)"
        out[name] = out[name].selectExpr(*[f"{hot} as customer_id" if c == "customer_id" else c
                                           for c in out[name].columns])
    return out


def write_dirty_invoices(invoices: DataFrame, path: str) -> None:
    """The invoices as CSV with some amounts that are no numbers, due dates that are no
    dates, and lines with a field too many (an unquoted comma in a market)."""
    key = "cast(substr(invoice_id, 4) as bigint)"
    dirty = {"amount": f"case when {key} % 97 = 3 then 'n/a' when {key} % 97 = 5 then '12.5.1' "
                       "else cast(amount as string) end",
             "due_date": f"case when {key} % 89 = 7 then '2024-02-31' else due_date end",
             "country": f"case when {key} % 101 = 9 then concat(country, ',', country) else country end"}
    rows = invoices.selectExpr(*[f"{dirty[c]} as {c}" if c in dirty else f"nullif({c}, '') as {c}"
                                 for c in invoices.columns])
    # without a quote character, so that the comma stands as it is
    rows.write.option("header", True).option("quote", "\u0000").csv(path)
