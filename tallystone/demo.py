"""Dirty exports derived from the TPC-H-like test tables, in Spark and in plain SQL.

Every defect the pipeline handles is injected by key arithmetic. The column expressions
are written once; only the few functions that Spark SQL and DuckDB spell differently come
from a dialect, so both engines start from the same texts.
"""

from pyspark.sql import functions as F

RUN_TS = "2026-01-15 06:00:00"
LOAD_TS = "2026-01-10 00:00:00"
YEAR = 2018

# The two funds and the short names the ledger uses for them.
RECEIVABLES = "Northgate Receivables Fund"
TERM = "Northgate Term Credit Fund"
ALIASES = {"Receivables": RECEIVABLES, "Term Credit": TERM}


class SparkText:
    """Functions as Spark SQL spells them."""

    date_forms = {"iso": "yyyy-MM-dd", "us": "MM/dd/yyyy", "short_us": "MM/dd/yy",
                  "long": "MMM dd, yyyy", "ledger": "dd-MMM-yy"}

    def idiv(self, a, b):
        return f"({a} div {b})"

    def commas(self, decimal):
        return f"format_number({decimal}, 2)"

    def date(self, value, form):
        return f"date_format({value}, '{self.date_forms[form]}')"

    def years_on(self, timestamp, years):
        return f"add_months(cast({timestamp} as date), {12 * years})"

    def days_on(self, day, days):
        return f"date_add(date '{day}', cast({days} as int))"


class DuckText(SparkText):
    """The same functions as DuckDB spells them."""

    date_forms = {"iso": "%Y-%m-%d", "us": "%m/%d/%Y", "short_us": "%m/%d/%y",
                  "long": "%b %d, %Y", "ledger": "%d-%b-%y"}

    def idiv(self, a, b):
        return f"({a} // {b})"

    def commas(self, decimal):
        return f"format('{{:,.2f}}', {decimal})"

    def date(self, value, form):
        return f"strftime({value}, '{self.date_forms[form]}')"

    def years_on(self, timestamp, years):
        return f"cast(cast({timestamp} as date) + interval {years} year as date)"

    def days_on(self, day, days):
        return f"(date '{day}' + cast({days} as int))"


def _padded(key, width=12):
    return f"lpad(cast({key} as string), {width}, '0')"


def _stamp(text=LOAD_TS):
    return f"cast('{text}' as timestamp)"


def _select(columns, source):
    listed = ",\n       ".join(f"{text} as {name}" for name, text in columns.items())
    return f"select {listed}\nfrom {source}"


def crm_sql(d, customer="customer", nation="nation"):
    """CRM records: suffix and casing variants, late duplicates, gaps, an unreadable date."""
    k = "c_custkey"
    source = f"{customer} join {nation} on c_nationkey = n_nationkey where {k} % 37 <> 0"
    first = {
        "org_ref": f"'CRM-' || {_padded(k)}",
        "org_name": f"""case when {k} % 499 = 3 then null
            when {k} % 5 = 1 then c_name || ' LLC' when {k} % 5 = 2 then c_name || ', Inc.'
            when {k} % 5 = 3 then c_name || ' Co.' when {k} % 5 = 4 then ' ' || c_name || ' LP '
            else c_name end""",
        "industry": f"case when {k} % 13 = 0 then null else c_mktsegment end",
        "state": "n_name",
        "relationship_owner": f"'Manager ' || cast({k} % 12 as string)",
        "date_added": f"""case when {k} % 211 = 7 then '13/45/20'
            else {d.date(d.days_on('2020-01-01', f'{k} % 1500'), 'short_us')} end""",
        "file_name": "'crm_export.csv'",
        "file_row_number": f"{k} + 1",
        "file_last_modified": _stamp(),
    }
    late = {
        **first,
        "org_ref": f"'CRX-' || {_padded(k)}",
        "org_name": "upper(c_name)",
        "industry": f"case when {k} % 40 = 0 then null else c_mktsegment end",
        "file_name": "'crm_late.csv'",
    }
    return _select(first, source) + "\nunion all\n" + _select(late, source + f" and {k} % 20 = 0")


def facility_sql(d, orders="orders", customer="customer"):
    """Facilities: spelling variants, reformatted copies, conflicts, gaps, unreadable values."""
    k = "o_orderkey"
    source = f"{orders} join {customer} on o_custkey = c_custkey"
    total = "cast(o_totalprice as decimal(18,2))"
    funded = d.years_on("o_orderdate", 20)
    matures = d.years_on("o_orderdate", 23)
    per_mille = f"(10 + 5 * ({k} % 40))"

    def money(value, spelling):
        return (f"case ({spelling}) % 3 when 0 then '$' || {d.commas(value)} "
                f"when 1 then {d.commas(value)} else cast({value} as string) end")

    def day(value, spelling):
        return (f"case ({spelling}) % 3 when 0 then {d.date(value, 'iso')} "
                f"when 1 then {d.date(value, 'us')} else {d.date(value, 'long')} end")

    def status(spelling):
        s = f"({spelling}) % 3"
        return f"""case o_orderstatus
            when 'O' then case {s} when 0 then 'Active' when 1 then 'ACTIVE' else 'active' end
            when 'F' then case {s} when 0 then 'Paid Off' when 1 then 'PAID-OFF' else 'paid off' end
            else case when {k} % 4 = 0 then case {s} when 0 then 'Closed' else 'CLOSED' end
                 else case {s} when 0 then 'Watch List' when 1 then 'Watchlist'
                      else 'WATCH-LIST' end end end"""

    def columns(turn):
        """``turn`` shifts the spelling, so copies differ in format but not in meaning."""
        s = f"{k} + {turn}"
        whole = d.idiv(per_mille, 10)
        return {
            "facility_id": f"'LN-' || {_padded(k)}",
            "client_name": f"""case when {k} % 503 = 5 then null
                else case ({s}) % 4 when 0 then '  ' || c_name || ' '
                when 1 then upper(c_name) || ' LLC' when 2 then c_name || ', INC.'
                else lower(c_name) end end""",
            "fund": f"case when {k} % 3 = 0 then '{RECEIVABLES}' else '{TERM}' end",
            "product_type": """case when o_orderpriority in ('1-URGENT', '2-HIGH')
                then 'Revolving Line' else 'Term Loan' end""",
            "status": status(s),
            "facility_limit": f"case when {k} % 307 = 11 then 'n/a' else {money(total, s)} end",
            "stated_balance": f"""case when {k} % 41 = 0 then null
                when {k} % 43 = 0 then '-' || cast({total} as string)
                else {money(total, s + ' + 1')} end""",
            "discount_rate": f"""case when ({s}) % 2 = 0
                then cast({whole} as string) || '.' || cast({per_mille} % 10 as string) || '%'
                else '0.' || lpad(cast({per_mille} as string), 3, '0') end""",
            "funding_date": f"case when {k} % 311 = 9 then '2024-13-45' else {day(funded, s)} end",
            "maturity_date": day(matures, f"{s} + 1"),
            "file_name": f"'facilities_{turn}.csv'",
            "file_row_number": f"{k} + 1",
            "file_last_modified": _stamp(),
        }

    second = columns(1)
    second.update({
        "facility_id": f"case when {k} % 1010 = 0 then null else {second['facility_id']} end",
        "status": f"case when {k} % 97 = 0 then 'Suspended' else {second['status']} end",
        "facility_limit": f"case when {k} % 89 = 0 then '1,000.00' "
                          f"else {second['facility_limit']} end",
        "stated_balance": f"case when {k} % 83 = 0 then '$77.50' "
                          f"else {second['stated_balance']} end",
    })
    third = columns(2)
    third.update({
        "status": f"case when {k} % 194 = 0 then null else {third['status']} end",
        "facility_limit": "'$2,000.00'",
    })
    copied = f"{source} where {k} % 10 = 0 or {k} % 97 = 0 or {k} % 89 = 0"
    return "\nunion all\n".join([
        _select(columns(0), source),
        _select(second, copied),
        _select(third, f"{source} where {k} % 178 = 0 or {k} % 194 = 0"),
    ])


def ledger_sql(d, lineitem="lineitem"):
    """Transactions: conflicts, agreeing copies, orphans, blanks, unreadable values."""
    k, line, part, supp = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    size = d.commas("cast(l_extendedprice as decimal(18,2))")
    day = d.years_on("l_shipdate", 20)
    order_line = f"cast({k} as string) || '-' || cast({line} as string)"
    columns = {
        "transaction_id": f"""case when {part} % 997 = 4 then null
            when {k} % 10 = 0 then 'TX-' || {order_line}
            else 'TX-' || {order_line} || '-' || cast({part} as string) || '-'
                 || cast({supp} as string) end""",
        "transaction_date": f"""case when {part} % 422 = 0 then '32-Foo-99'
            when {part} % 223 = 1 then null
            when {k} % 29 = 0 then {d.date(day, 'iso')} else {d.date(day, 'ledger')} end""",
        "fund": f"""case when ({k} + case when {k} % 31 = 0 then 1 else 0 end) % 3 = 0
            then case when {line} % 2 = 0 then 'Receivables' else '{RECEIVABLES}' end
            else case when {line} % 2 = 0 then 'Term Credit' else '{TERM}' end end""",
        "share_class": f"""case when {part} % 17 = 0 then null
            when l_linestatus = 'F' then 'Class A' else 'Class B' end""",
        "investment_ref": f"""case when {k} % 101 = 0 then 'LX-' || cast({k} % 7 as string)
            when {part} % 991 = 0 then null else 'LN-' || {_padded(k)} end""",
        "transaction_type": """case l_returnflag when 'N' then 'Funding'
            when 'R' then 'Remittance' else 'Servicer Fee' end""",
        "amount": f"""case when {part} % 422 = 211 then 'not-a-number'
            when {part} % 227 = 3 then null
            when l_returnflag <> 'R' or {part} % 59 = 0 then '(' || {size} || ')'
            else {size} end""",
        "file_name": f"""'ledger-' || cast({supp} as string) || '-'
            || cast({d.idiv(part, 100000)} as string) || '.csv'""",
        "file_row_number": f"({k} * 7 + {line} - 1) * 100000 + {part} % 100000",
        "file_last_modified": _stamp(),
    }
    again = {**columns, "file_name": f"'again-' || {columns['file_name']}"}
    return "\nunion all\n".join([
        _select(columns, lineitem),
        _select(again, f"{lineitem} where {part} % 53 = 0"),
    ])


def delta_sql(d, lineitem="lineitem"):
    """A later delivery of the whole ledger: most rows unchanged, some corrected, moved to
    another facility, entirely new, or unreadable."""
    turn = f"{d.idiv('file_row_number', 100000)} % 50"
    columns = {
        "transaction_id": f"""case {turn} when 4 then 'NEW-' || transaction_id
            when 5 then 'BAD-' || transaction_id else transaction_id end""",
        "transaction_date": "transaction_date",
        "fund": "fund",
        "share_class": "share_class",
        "investment_ref": f"""case when {turn} = 3 then 'LN-' ||
            {_padded(d.idiv(d.idiv('file_row_number', 700000), 2))} else investment_ref end""",
        "transaction_type": "transaction_type",
        "amount": f"case {turn} when 2 then '1,234.50' when 5 then 'nil' else amount end",
        "file_name": "'delta-' || file_name",
        "file_row_number": "file_row_number",
        "file_last_modified": _stamp("2026-01-20 00:00:00"),
    }
    return _select(columns, f"({ledger_sql(d, lineitem)}) first_delivery")


def request_sql(d, events="events", orders="orders"):
    """Remittance requests over the whole loan book: valid ones and every reason to refuse one."""
    k = "event_id"
    loan = _padded(f"{k} % (select max(o_orderkey) + 1 from {orders})")
    day = d.years_on("ts", 0)
    columns = {
        "request_id": f"'RQ-' || {_padded(k)}",
        "facility_id": f"""case when {k} % 19 = 0 then 'LZ-' || cast({k} as string)
            when {k} % 4 = 0 then 'ln-' || {loan}
            when {k} % 2003 = 1 then null else 'LN-' || {loan} end""",
        "amount": f"""case when {k} % 23 = 0 then 'abc' when {k} % 29 = 0 then '0'
            when {k} % 31 = 0 then '-1' when {k} % 2003 = 2 then null
            else cast(cast(value as decimal(18,2)) as string) end""",
        "transaction_date": f"""case when {k} % 37 = 0 then '2026-01-16'
            when {k} % 41 = 0 then 'soon' else {d.date(day, 'iso')} end""",
        "share_class": f"""case when {k} % 3 = 0 then null when {k} % 43 = 0 then 'Class Z'
            when {k} % 3 = 1 then 'class a' else 'Class B' end""",
    }
    return _select(columns, events)


def spread(rows):
    """The rows as they lie if their splits keep all cores busy, and dealt out anew if not.

    A split without a row group is empty, so a table in a few row groups is read by a few tasks.
    Counting the rows of the splits reads no column.
    """
    splits = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    found = splits.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    uneven = found.most is not None and found.most * cores > 2 * found["all"]
    return rows.hint("rebalance") if uneven else rows


def _run(spark, sf_dir, build, tables):
    """The dirty view as a DataFrame over the parquet tables.

    The first table is the large one. Where it lies in a few row groups it is dealt out as numbers,
    before texts several times their size are made of them.
    """
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    read[tables[0]] = spread(read[tables[0]])
    text = build(SparkText(), **{t: f"@{t}@" for t in tables})
    for table in tables:
        text = text.replace(f"@{table}@", "{" + table + "}")
    return spark.sql(text.replace("as timestamp)", "as timestamp_ntz)"), **read)


def crm_raw(spark, sf_dir):
    return _run(spark, sf_dir, crm_sql, ["customer", "nation"])


def facility_raw(spark, sf_dir):
    return _run(spark, sf_dir, facility_sql, ["orders", "customer"])


def ledger_raw(spark, sf_dir):
    return _run(spark, sf_dir, ledger_sql, ["lineitem"])


def ledger_delta(spark, sf_dir):
    return _run(spark, sf_dir, delta_sql, ["lineitem"])


def requests(spark, sf_dir):
    return _run(spark, sf_dir, request_sql, ["events", "orders"])
