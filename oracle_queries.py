"""The registered queries as plain SQL for DuckDB, written independently of the Spark code.

Where the library aggregates, this uses windows, and the other way round, so that the two
agree only if both are right.
"""

from tallystone import demo
from tallystone.model import CRM_FIELDS, FACILITY_FIELDS
from tallystone.plans.quality import RULES

D = demo.DuckText()
RUN = f"timestamp '{demo.RUN_TS}'"
SECOND = "timestamp '2026-02-01 06:00:00'"
FOREVER = "timestamp '9999-12-31 23:59:59'"
YEAR = demo.YEAR
NOFAC = "md5('NULL FACILITY')"
NOORG = "md5('NULL ORGANIZATION')"


def key(name):
    letters = f"regexp_replace(upper({name}), '[^A-Z0-9 ]', '', 'g')"
    squeezed = f"trim(regexp_replace({letters}, ' +', ' ', 'g'))"
    bare = f"regexp_replace({squeezed}, ' (LLC|INC|CO|LP|LTD|CORP|COMPANY)$', '')"
    return f"nullif(trim({bare}), '')"


def money(text):
    return f"try_cast(regexp_replace({text}, '[$,]', '', 'g') as decimal(35,3))"


def amount(text):
    bare = f"try_cast(regexp_replace({text}, '[,()]', '', 'g') as decimal(35,3))"
    return f"case when {text} like '(%)' then -{bare} else {bare} end"


def rate(text):
    return (f"cast(case when {text} like '%\\%%' escape '\\' then try_cast(replace({text}, '%', '') "
            f"as decimal(9,4)) * cast(0.01 as decimal(3,2)) else try_cast({text} as decimal(9,4)) "
            f"end as decimal(5,4))")


def day(text):
    return f"""case when {text} like '%-%' then cast(try_strptime({text}, '%Y-%m-%d') as date)
        when regexp_matches({text}, '[A-Za-z]') then cast(try_strptime({text}, '%b %d, %Y') as date)
        when {text} like '%/%' then cast(try_strptime({text}, '%m/%d/%Y') as date) end"""


def ledger_day(text):
    return f"""case when regexp_matches({text}, '^\\d{{4}}-')
        then cast(try_strptime({text}, '%Y-%m-%d') as date)
        else cast(try_strptime({text}, '%d-%b-%y') as date) end"""


def status(text):
    code = f"replace(upper(trim({text})), ' ', '-')"
    return f"case when {code} = 'WATCHLIST' then 'WATCH-LIST' else {code} end"


def hashed(columns):
    parts = ", ".join(f"coalesce(cast({c} as varchar), '~NULL~')" for c in columns)
    return f"md5(concat_ws('||', {parts}))"


def agreed(column):
    one = f"count(distinct coalesce(cast({column} as varchar), '~NULL~')) = 1"
    return f"case when {one} then max({column}) end as {column}"


def disputed(column):
    return (f"count(distinct coalesce(cast({column} as varchar), '~NULL~')) > 1 "
            f"as {column}_conflict_ind")


FAC = ["organization_sk", "fund_description", "product_type", "discount_rate",
       "net_funds_employed", "facility_funding_limit", "funding_date", "maturity_date", "status"]
TXN = ["transaction_date", "fund_description", "share_class", "facility_id",
       "transaction_type", "amount"]
ORG_HASH = ["organization_id", "organization_name", "industry", "state", "relationship_owner",
            "date_added", "source_system"]
FACT = ["transaction_sk", "transaction_id", "transaction_date", "fund_description",
        "share_class", "facility_sk", "facility_id", "transaction_type", "amount",
        "known_facility_ind", "adjustment_ind"]
CRM_RAW = ("org_ref, org_name, industry, state, relationship_owner, date_added, file_name, "
           "file_row_number, file_last_modified")
FAC_RAW = ("facility_id, client_name, fund, product_type, status, facility_limit, "
           "stated_balance, discount_rate, funding_date, maturity_date, file_name, "
           "file_row_number, file_last_modified")


def parsed_ledger(raw):
    return f"""select *, {ledger_day('transaction_date_raw')} as transaction_date,
        case fund when 'Receivables' then '{demo.RECEIVABLES}' when 'Term Credit'
             then '{demo.TERM}' else fund end as fund_description,
        investment_ref as facility_id, {amount('amount_raw')} as amount
        from (select * rename (transaction_date as transaction_date_raw, amount as amount_raw)
              from {raw})"""


def failing(source):
    return f"""select *, concat_ws(', ',
        case when coalesce(trim(transaction_id), '') = '' then 'TRANSACTION_ID' end,
        case when coalesce(trim(transaction_date_raw), '') <> '' and transaction_date is null
             then 'TRANSACTION_DATE' end,
        case when coalesce(trim(amount_raw), '') <> '' and amount is null then 'AMOUNT' end)
        as parse_fail_fields from ({source})"""


def resolved(source):
    return f"""select md5(transaction_id) as transaction_sk, transaction_id,
        {', '.join(agreed(c) for c in TXN)}
        from {source} where parse_fail_fields = '' group by transaction_id"""


def fact_rows(staged, dim="stated"):
    return f"""select *, {hashed(FACT)} as change_tracking_key from (
        select t.transaction_sk, t.transaction_id, t.transaction_date,
               coalesce(f.fund_description, t.fund_description) as fund_description,
               t.share_class, coalesce(f.facility_sk, {NOFAC}) as facility_sk, t.facility_id,
               t.transaction_type, t.amount, f.facility_id is not null as known_facility_ind,
               coalesce(t.transaction_type = 'Remittance' and t.amount < 0, false)
                   as adjustment_ind
        from {staged} t left join {dim} f on f.facility_id = t.facility_id)"""


def stated(raw, name):
    """Facility staging rows from a raw CTE, as two CTEs."""
    return {
        f"{name}_p": f"""select * exclude (fund_description_, o) , o as organization_sk,
            fund_description_ as fund_description from (
            select facility_id, fund as fund_description_, product_type,
                md5(coalesce({key('client_name')}, 'NULL ORGANIZATION')) as o,
                {rate('discount_rate')} as discount_rate,
                {money('stated_balance')} as net_funds_employed,
                {money('facility_limit')} as facility_funding_limit,
                {day('funding_date')} as funding_date, {day('maturity_date')} as maturity_date,
                {status('status')} as status, file_name, file_row_number
            from {raw})""",
        f"{name}_c": f"""select facility_id, count(*) as copies,
            {', '.join(agreed(c) for c in FAC)}, {', '.join(disputed(c) for c in FAC)}
            from {name}_p where coalesce(trim(facility_id), '') <> '' group by facility_id""",
        name: f"""select *, {hashed(['facility_sk', 'facility_id', *FAC])} as change_tracking_key
            from (select md5(facility_id) as facility_sk, facility_id, {', '.join(FAC)}
                  from {name}_c)""",
    }


def orgs(crm, fac, name):
    return {
        f"{name}_p": f"""select *, {key('org_name')} as match_key,
            cast(try_strptime(date_added, '%m/%d/%y') as date) as joined_on from {crm}""",
        f"{name}_1": f"""select md5(match_key) as organization_sk, org_ref as organization_id,
            upper(trim(org_name)) as organization_name, industry, state, relationship_owner,
            joined_on as date_added, 'CRM' as source_system
            from {name}_p where match_key is not null
            qualify row_number() over (partition by match_key
                order by org_ref, file_name, file_row_number) = 1""",
        f"{name}_2": f"""select md5(k) as organization_sk, 'SV-' || upper(md5(k)) as organization_id,
            n as organization_name, null as industry, null as state, null as relationship_owner,
            cast(null as date) as date_added, 'SERVICING' as source_system
            from (select {key('client_name')} as k, upper(trim(client_name)) as n from {fac})
            where k is not null and not exists
                (select 1 from {name}_1 c where c.organization_sk = md5(k))
            qualify row_number() over (partition by k order by n) = 1""",
        name: f"""select *, {hashed(ORG_HASH)} as change_tracking_key
            from (select * from {name}_1 union all by name select * from {name}_2)""",
    }


RUNNING = """select *, sum(amount) over (partition by facility_id
    order by transaction_date asc nulls last) as facility_balance from {fact}"""


def latest_balance(fact):
    return f"""select facility_sk, cast(-facility_balance as decimal(35,3)) as net_funds_employed
        from ({RUNNING.format(fact=fact)}) where facility_sk <> {NOFAC}
        qualify row_number() over (partition by facility_sk
            order by transaction_date desc nulls first) = 1"""


def corrected(dim, nfe):
    return f"""select f.* replace (case when n.facility_sk is not null
        then n.net_funds_employed else f.net_funds_employed end as net_funds_employed)
        from {dim} f left join {nfe} n using (facility_sk)"""


CTES = {
    "raw_crm": demo.crm_sql(D),
    "raw_fac": demo.facility_sql(D),
    "raw_led": demo.ledger_sql(D),
    "raw_delta": demo.delta_sql(D),
    "raw_requests": demo.request_sql(D),
    **orgs("raw_crm", "raw_fac", "org"),
    **stated("raw_fac", "stated"),
    "led": failing(parsed_ledger("raw_led")),
    "delta": failing(parsed_ledger("raw_delta")),
    "staged": resolved("led"),
    "staged_delta": resolved("delta"),
    "fact": fact_rows("staged"),
    "fact_delta": fact_rows("staged_delta"),
    "fact_after": f"""select {', '.join(f'case when d.transaction_id is null then f.{c} else d.{c} end as {c}' for c in [*FACT, 'change_tracking_key'])},
        coalesce(f.fi, timestamp '2026-02-01 06:00:00') as record_inserted_ts,
        case when f.transaction_id is not null and d.change_tracking_key <> f.change_tracking_key
             then timestamp '2026-02-01 06:00:00' end as record_updated_ts,
        case when f.transaction_id is null then 'INSERT' when d.transaction_id is null then 'UNTOUCHED'
             when d.change_tracking_key <> f.change_tracking_key then 'UPDATE'
             else 'UNCHANGED' end as outcome
        from (select *, {RUN} as fi from fact) f
        full outer join fact_delta d on d.transaction_id = f.transaction_id""",
    "nfe": latest_balance("fact"),
    "nfe_after": latest_balance("fact_after"),
    "dim": corrected("stated", "nfe"),
    "dim_after": corrected("stated", "nfe_after"),
    "borrower": f"""select organization_sk, organization_id, organization_name, industry, state,
        relationship_owner, source_system from org union all select {NOORG}, 'NULL ORGANIZATION',
        'NULL ORGANIZATION', 'NULL ORGANIZATION', 'NULL ORGANIZATION', 'NULL ORGANIZATION',
        'SYNTHETIC'""",
    "loan": """select d.*, b.organization_id, b.organization_name, b.industry
        from dim d left join borrower b on b.organization_sk = d.organization_sk
         and b.organization_id <> 'NULL ORGANIZATION'""",
    "labelled": """select d.*, b.source_system, case when b.organization_sk is null
        or b.source_system = 'SYNTHETIC' then 'Unmapped borrower' when b.source_system = 'SERVICING' then 'NOT IN CRM'
        when b.industry is null then 'INDUSTRY NOT SET' else b.industry end as industry
        from dim d left join borrower b on b.organization_sk = d.organization_sk""",
}


def q(sql):
    """Prefix the CTEs a statement needs, found by name, in dependency order."""
    import re

    needed, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    with_list = ",\n".join(f"{n} as materialized ({CTES[n]})" for n in CTES if n in needed)
    return f"with {with_list}\n{sql}" if with_list else sql


def pct(part, whole):
    return f"round(cast({part} as double) / cast({whole} as double) * 100, 2)"


OPEN = "status in ('ACTIVE', 'WATCH-LIST')"
IN_YEAR = f"year(transaction_date) = {YEAR}"


def big(expr):
    return f"cast({expr} as bigint)"


def scd_columns(version="1", current="true", start=RUN, end=FOREVER, sk="organization_sk"):
    return f"""cast({version} as integer) as record_version_number, {current} as is_current_ind,
        {start} as record_valid_from_ts, {end} as record_valid_to_ts,
        md5({sk} || '||{version}') as scd_id"""


def second_run(first, second, sk):
    """History after two loads: unchanged members, closed versions and new versions."""
    return f"""
    select a.*, {scd_columns(sk=f'a.{sk}')} from {first} a left join {second} b using ({sk})
        where b.{sk} is null or a.change_tracking_key = b.change_tracking_key
    union all by name
    select a.*, {scd_columns(current='false', end=f"({SECOND} - interval 1 millisecond)", sk=f'a.{sk}')}
        from {first} a join {second} b using ({sk})
        where a.change_tracking_key <> b.change_tracking_key
    union all by name
    select b.*, {scd_columns(version='2', start=SECOND, sk=f'b.{sk}')}
        from {first} a join {second} b using ({sk})
        where a.change_tracking_key <> b.change_tracking_key
    union all by name
    select b.*, {scd_columns(start=SECOND, sk=f'b.{sk}')} from {second} b
        where b.{sk} not in (select {sk} from {first})"""


def guard_rows():
    return f"""
    select 'organization' as dimension, {NOORG} as sk, 'NULL ORGANIZATION' as member_id,
        cast(count(*) as bigint) as members from org
    union all
    select 'facility', {NOFAC}, 'NULL FACILITY', cast(count(*) as bigint) from stated"""


AUDITED_ORG = f"""select {CRM_RAW},
    row_number() over (partition by match_key order by file_name, file_row_number) as record_number,
    duplicate_ind, coalesce(duplicate_ind and winner = 1, false) as winner_ind, parse_fail_fields
    from (select *, count(*) over (partition by match_key) > 1 and match_key is not null
                 as duplicate_ind,
          row_number() over (partition by match_key order by org_ref, file_name, file_row_number)
                 as winner,
          concat_ws(', ', case when match_key is null then 'ORG_NAME' end,
              case when coalesce(trim(date_added), '') <> '' and joined_on is null
                   then 'DATE_ADDED' end) as parse_fail_fields from org_p)
    where duplicate_ind or parse_fail_fields <> ''"""

AUDITED_FAC = f"""select {FAC_RAW},
    row_number() over (partition by facility_id order by file_name, file_row_number)
        as record_number, duplicate_ind, parse_fail_fields
    from (select *, count(*) over (partition by facility_id) > 1 and facility_id is not null
        as duplicate_ind,
        concat_ws(', ', case when coalesce(trim(facility_id), '') = '' then 'FACILITY_ID' end,
          case when discount_rate is not null and {rate('discount_rate')} is null
               then 'DISCOUNT_RATE' end,
          case when stated_balance is not null and {money('stated_balance')} is null
               then 'STATED_BALANCE' end,
          case when facility_limit is not null and {money('facility_limit')} is null
               then 'FACILITY_LIMIT' end,
          case when funding_date is not null and {day('funding_date')} is null
               then 'FUNDING_DATE' end,
          case when maturity_date is not null and {day('maturity_date')} is null
               then 'MATURITY_DATE' end) as parse_fail_fields
        from raw_fac)
    where duplicate_ind or parse_fail_fields <> ''"""


def flagged(source="led"):
    def clash(c):
        shown = f"case when parse_fail_fields = '' then coalesce(cast({c} as varchar), '~NULL~') end"
        over = "over (partition by transaction_id)"
        return (f"coalesce(min({shown}) {over} <> max({shown}) {over}, false) "
                f"as {c}_conflict_ind")

    return f"""select *, {' or '.join(f'{c}_conflict_ind' for c in TXN)} as conflict_ind from (
        select *, parse_fail_fields <> '' as parse_fail_ind,
        count(*) over (partition by transaction_id) > 1 as duplicate_ind,
        row_number() over (partition by transaction_id order by file_name, file_row_number)
            as record_number, {', '.join(clash(c) for c in TXN)}
        from {source})"""


AUDITED_TXN = f"""select transaction_id, transaction_date_raw as transaction_date, fund, share_class,
    investment_ref, transaction_type, amount_raw as amount, file_name, file_row_number,
    file_last_modified, record_number,
    {hashed(['file_name', 'file_row_number', 'transaction_id'])} as audit_record_sk,
    duplicate_ind, conflict_ind, parse_fail_ind, parse_fail_fields, {RUN} as batch_ts
    from ({flagged()}) where duplicate_ind or conflict_ind or parse_fail_ind"""


def quality_log():
    quoted = ", ".join(
        "(" + ", ".join("null" if v is None else "'" + v.replace("'", "''") + "'"
                        for v in (rule, "TABLE", *entry)) + ")"
        for rule, entry in RULES.items()
    )
    dressed = "regexp_matches({c}, '[$,]')"
    iso = "not regexp_matches({c}, '^\\d{{4}}-\\d\\d-\\d\\d$')"
    closed = "(select facility_id from dim where status = 'CLOSED')"
    counts = {
        "org_copies": "select count(match_key) - count(distinct match_key) from org_p",
        "org_key": "select count(*) from raw_crm",
        "org_date_text": "select count(date_added) from raw_crm",
        "org_date_bad": "select count(*) from org_p where date_added is not null and joined_on is null",
        "org_unnamed": "select count(*) from org_p where match_key is null",
        "org_servicing": "select count(*) from org where source_system = 'SERVICING'",
        "fac_key": "select count(*) from raw_fac",
        "fac_status": f"select count(*) from raw_fac where status <> {status('status')}",
        "fac_rate": "select count(*) from raw_fac where discount_rate like '%\\%' escape '\\'",
        "fac_balance": f"select count(*) from raw_fac where {dressed.format(c='stated_balance')}",
        "fac_limit": f"select count(*) from raw_fac where {dressed.format(c='facility_limit')}",
        "fac_funded": f"select count(*) from raw_fac where {iso.format(c='funding_date')}",
        "fac_matures": f"select count(*) from raw_fac where {iso.format(c='maturity_date')}",
        "fac_copies": "select count(*) from stated_c where copies > 1 and not ("
                      + " or ".join(f"{c}_conflict_ind" for c in FAC) + ")",
        "fac_status_conflict": "select count(*) from stated_c where status_conflict_ind",
        "fac_limit_conflict":
            "select count(*) from stated_c where facility_funding_limit_conflict_ind",
        "fac_balance_conflict":
            "select count(*) from stated_c where net_funds_employed_conflict_ind",
        "fac_orphans": "select count(*) from dim where organization_sk is null or organization_sk "
                       "not in (select organization_sk from borrower)",
        "txn_key": "select count(*) from raw_led",
        "txn_facility_key": "select count(investment_ref) from raw_led",
        "txn_date": "select count(transaction_date) from raw_led",
        "txn_amount": "select count(*) from raw_led where amount like '(%'",
        "txn_alias": "select count(*) from led where fund <> fund_description",
        "txn_fund_conflict": f"select count(*) from (select transaction_id, "
                             f"{disputed('fund_description')} from led where parse_fail_fields = '' "
                             f"group by 1) where fund_description_conflict_ind",
        "txn_amount_conflict": f"select count(*) from (select transaction_id, "
                               f"{disputed('amount')} from led where parse_fail_fields = '' "
                               f"group by 1) where amount_conflict_ind",
        "txn_bad": "select count(*) from led where parse_fail_fields <> ''",
        "txn_resent": "select count(*) from staged_delta where transaction_id in "
                      "(select transaction_id from fact)",
        "fact_fund": "select count(*) from staged s join stated f on f.facility_id = s.facility_id "
                     "where s.fund_description <> f.fund_description",
        "dim_balance": "select count(*) from dim d join stated s using (facility_id) "
                       "where d.net_funds_employed is distinct from s.net_funds_employed",
        "fact_orphans": "select count(*) from fact where not known_facility_ind",
        "fact_negative": "select count(*) from fact where adjustment_ind",
        "fact_closed": f"select count(*) from fact where transaction_type = 'Remittance' and "
                       f"facility_id in {closed}",
    }
    assert counts.keys() == RULES.keys()
    measured = " union all ".join(
        f"select '{rule}' as rule, ({sql}) as affected_rows" for rule, sql in counts.items()
    )
    return f"""select * exclude (rule), row_number() over (order by object_schema, object_name,
        coalesce(field_name, '~NULL~'), issue_type, rule) as log_id
        from (values {quoted}) c(rule, object_type, object_schema, object_name, field_name,
        issue_type, issue_description, issue_resolution) join ({measured}) m using (rule)"""


def investor_summary():
    cell = f"""cast(count(*) as bigint) as facility_count,
        count(distinct nullif(organization_sk, {NOORG})) as borrower_count,
        sum(net_funds_employed) as outstanding_balance"""
    position = f"case when {OPEN} then 'OPEN' else 'NOT OPEN' end"
    return f"""select *, {pct('outstanding_balance', '(select sum(net_funds_employed) from dim)')}
        as pct_of_portfolio from (
        select 1 as display_order, 'PORTFOLIO' as metric_group, 'TOTAL' as metric_label, {cell} from dim
        union all select 2, 'FUND', fund_description, {cell} from dim group by fund_description
        union all select 3, 'POSITION STATUS', {position}, {cell} from dim group by {position}
        union all select 4, 'CONCENTRATION', 'TOP 5 BORROWERS BY OPEN EXPOSURE',
            cast(sum(n) as bigint), count(*), sum(t) from (
            select organization_sk, count(*) as n, sum(net_funds_employed) as t from dim
            where {OPEN} and organization_sk <> {NOORG} group by organization_sk
            order by t desc nulls last, organization_sk limit 5))"""


def portfolio_summary():
    zero = "coalesce(sum(net_funds_employed), 0)"
    missing = "count(*) filter (where net_funds_employed is null)"
    return f"""select *, round(coalesce(cast(outstanding as double)
        / nullif(cast((select sum(net_funds_employed) from loan) as double), 0), 0), 6)
        as share_of_total from (
        select 'TOTAL' as section, 'ALL' as label, count(*) as loans, {missing} as missing_balance,
               {zero} as outstanding from loan
        union all select 'STATUS', status, count(*), {missing}, {zero} from loan group by status
        union all (select 'TOP BORROWER', organization_id, count(*), null, {zero} as o
                   from loan group by organization_id
                   order by o desc, organization_id nulls first limit 5))"""


def integrity():
    """Every check's count, from the relations themselves."""
    def repeated(relation, key):
        return (f"(select count(*) from (select {key} from {relation} group by 1 "
                f"having count(*) > 1))")

    counts = {
        "orphan_facilities_marts": "(select count(*) from dim where organization_sk not in "
                                   "(select organization_sk from borrower))",
        "orphan_facilities_staging": f"(select count(*) from stated where organization_sk <> {NOORG} "
                                     "and organization_sk not in (select organization_sk from org))",
        "duplicate_org_sk_marts": repeated("borrower", "organization_sk"),
        "duplicate_org_sk_staging": repeated("org", "organization_sk"),
        "duplicate_facility_sk_marts": repeated("dim", "facility_sk"),
        "duplicate_transaction_id": repeated("fact", "transaction_id"),
    }
    lines = " union all ".join(f"select '{name}' as check_name, {sql} as found"
                               for name, sql in counts.items())
    return f"select *, case when found = 0 then 'PASS' else 'FAIL' end as result from ({lines})"


def reconciliations():
    def line(name, left, right, test):
        return (f"select '{name}' as check_name, cast({left} as decimal(38,3)) as left_value, "
                f"cast({right} as decimal(38,3)) as right_value, "
                f"case when {left} {test} {right} then 'PASS' else 'FAIL' end as result")

    year = f"transaction_type = 'Remittance' and {IN_YEAR}"
    book = "(select sum(net_funds_employed) from dim)"
    return " union all ".join([
        line("headline_vs_industry", book, "(select sum(net_funds_employed) from labelled)", "="),
        line("facilities_vs_industry", "(select count(*) from dim)",
             "(select count(*) from labelled)", "="),
        line("unlabelled_facilities", "(select count(*) from labelled where industry is null)",
             "0", "="),
        line("open_book_within_portfolio",
             f"(select sum(net_funds_employed) from dim where {OPEN})", book, "<="),
        line("orphans_on_real_facilities",
             f"(select count(*) from fact where not known_facility_ind and facility_sk <> {NOFAC})",
             "0", "="),
        line("grid_vs_ungridded", f"(select coalesce(sum(total), 0) from (select fund_description, sum(amount) as total "
             f"from fact where {year} group by 1))",
             f"(select coalesce(sum(amount), 0) from fact where {year})", "="),
    ])


REQUESTS = f"""select r.*, l.facility_id as known_id, l.fund_description as known_fund,
    try_cast(r.amount as decimal(35,3)) as a,
    cast(try_strptime(r.transaction_date, '%Y-%m-%d') as date) as d,
    case when coalesce(trim(r.facility_id), '') = '' or a is null or d is null
           or upper(r.share_class) not in ('CLASS A', 'CLASS B') then 'VALIDATION_ERROR'
         when a <= 0 then 'AMOUNT_NOT_POSITIVE'
         when d > date '2026-01-15' then 'TRANSACTION_DATE_IN_FUTURE'
         when l.facility_id is null then 'FACILITY_NOT_FOUND' end as rejection_code
    from raw_requests r left join loan l on upper(l.facility_id) = upper(r.facility_id)"""

AUDIT_COUNTS = """count(*) as listed, count(*) filter (where duplicate_ind) as duplicates,
    count(*) filter (where conflict_ind) as conflicts,
    count(*) filter (where parse_fail_ind) as unreadable"""


ORG_COLUMNS = ("organization_sk, organization_id, organization_name, industry, state, "
               "relationship_owner, date_added, source_system, change_tracking_key")
CONFLICTS = ", ".join(f"{c}_conflict_ind" for c in FAC)


def oracle():
    fac_first = "(select * from raw_fac where file_name = 'facilities_0.csv')"
    second_fac = stated(fac_first, "stated2")
    second_org = orgs("(select * from raw_crm where file_name = 'crm_export.csv')", fac_first,
                      "org2")
    CTES.update(second_fac)
    CTES.update(second_org)
    CTES["deliveries"] = failing(parsed_ledger(
        "(select * from raw_led union all by name select * from raw_delta)"))
    CTES["newest"] = """select * from deliveries where parse_fail_fields = '' qualify file_last_modified
        = max(file_last_modified) over (partition by transaction_id)"""
    guard_move = """select facility_id, status, b.net_funds_employed as nfe_before,
        a.net_funds_employed as nfe_after, a.net_funds_employed - b.net_funds_employed as nfe_change
        from dim b join (select * exclude (status) from dim_after) a using (facility_id)"""
    sql = {
        "parse_amount": f"""select file_name, file_row_number, amount as amount_text,
            {amount('amount')} as amount_value from raw_led""",
        "parse_dates": f"""select 'funding' as kind, funding_date as date_text,
            {day('funding_date')} as date_value, count(*) as n from raw_fac group by all union all
            select 'maturity', maturity_date, {day('maturity_date')}, count(*) from raw_fac
            group by all union all select 'ledger', transaction_date,
            {ledger_day('transaction_date')}, count(*) from raw_led group by all union all
            select 'crm', date_added, joined_on, count(*) from org_p group by all""",
        "parse_rate": f"""select file_name, file_row_number, discount_rate as rate_text,
            {rate('discount_rate')} as rate_value, facility_limit as limit_text,
            {money('facility_limit')} as limit_value from raw_fac""",
        "normalize_status": f"""select status as status_text, {status('status')} as status_code,
            count(*) as n from raw_fac group by all""",
        "match_key": f"""select org_name as name, {key('org_name')} as match_key, count(*) as n
            from raw_crm group by all union all
            select client_name, {key('client_name')}, count(*) from raw_fac group by all""",
        "row_hash": "select facility_id, facility_sk, change_tracking_key from stated",
        "file_provenance": """select count(*) as raw_rows, count(*) as numbered_rows,
            true as every_file_numbered_from_one from raw_led""",
        "load_once": """select transaction_id, file_name, file_row_number from raw_led
            where file_name like 'again-%'""",
        "org_dedup": f"select {ORG_COLUMNS.rsplit(',', 1)[0]} from org_1",
        "org_conformed": f"select {ORG_COLUMNS} from org",
        "org_audit": f"""select *, {hashed(['org_ref', 'record_number'])} as duplicate_id
            from ({AUDITED_ORG})""",
        "facility_clean": f"""select facility_sk, facility_id, {', '.join(FAC)},
            change_tracking_key from stated""",
        "facility_conflicts": f"""select facility_id, copies, {', '.join(FAC)}, {CONFLICTS},
            {' or '.join(f'{c}_conflict_ind' for c in FAC)} as conflict_ind from stated_c""",
        "facility_audit": f"""select *, {hashed(['facility_id', 'record_number'])} as duplicate_id
            from ({AUDITED_FAC})""",
        "txn_parsed": """select file_name, file_row_number, transaction_id, transaction_date_raw,
            amount_raw, transaction_date, fund_description, share_class, facility_id,
            transaction_type, amount, parse_fail_fields from led""",
        "txn_flags": f"""select file_name, file_row_number, transaction_id, record_number,
            duplicate_ind, {', '.join(f'{c}_conflict_ind' for c in TXN)}, conflict_ind,
            parse_fail_ind, parse_fail_fields from ({flagged()})""",
        "txn_resolved": f"select transaction_sk, transaction_id, {', '.join(TXN)} from staged",
        "txn_newest_delivery": f"""select transaction_sk, transaction_id, {', '.join(TXN)}
            from ({resolved('newest')})""",
        "txn_audit": AUDITED_TXN,
        "audit_append": AUDITED_TXN,
        "dq_log": quality_log(),
        "scd2_initial": f"select {ORG_COLUMNS}, {scd_columns()} from org union all by name "
                        f"select {NOORG} as organization_sk, 'NULL ORGANIZATION' as organization_id, "
                        f"'NULL ORGANIZATION' as organization_name, 'NULL ORGANIZATION' as industry, "
                        f"'NULL ORGANIZATION' as state, 'NULL ORGANIZATION' as relationship_owner, "
                        f"cast(null as date) as date_added, 'SYNTHETIC' as source_system, "
                        f"{NOORG} as change_tracking_key, {scd_columns(sk=NOORG)}",
        "scd2_second_run": second_run("stated", "stated2", "facility_sk"),
        "scd2_second_run_organizations": second_run("org", "org2", "organization_sk"),
        "guard_rows": guard_rows(),
        "fact_resolved": f"select {', '.join(FACT)}, change_tracking_key from fact",
        "fact_upsert": f"""select {', '.join(FACT)}, change_tracking_key, record_inserted_ts,
            record_updated_ts from fact_after""",
        "upsert_outcomes": "select transaction_id, outcome from fact_after",
        "fact_resend_noop": "select 'UNCHANGED' as outcome, count(*) as n from fact",
        "orphan_reresolution": f"""select transaction_id, facility_sk, fund_description,
            change_tracking_key from fact where known_facility_ind and facility_id in
            (select facility_id from stated where fund_description = '{demo.RECEIVABLES}')""",
        "running_balance": f"""select transaction_id, facility_id, transaction_date, amount,
            facility_balance from ({RUNNING.format(fact='fact')})""",
        "full_rebuild": """select 'organization' as table_name, count(*) + 1 as rows from org
            union all select 'facility', count(*) + 1 from stated
            union all select 'fact', count(*) from fact""",
        "net_funds": "select facility_sk, net_funds_employed from nfe",
        "balance_correction": """select d.facility_id, s.net_funds_employed as stated_balance,
            d.net_funds_employed from dim d join stated s using (facility_id)""",
        "nfe_movement": f"select * from ({guard_move}) where nfe_before is distinct from nfe_after",
        "stream_incremental": """select facility_id, net_funds_employed from dim_after""",
        "stream_fact": f"select {', '.join(FACT)}, change_tracking_key from fact_after",
        "stream_run_summary": f"""select 1 as run, (select count(*) from raw_led) as batch,
            (select count(*) from ({AUDITED_TXN})) as audited, (select count(*) from fact) as staged,
            (select count(*) from fact) as changed union all
            select 2, (select count(*) from raw_delta), (select count(*) from ({flagged('delta')})
                where duplicate_ind or conflict_ind or parse_fail_ind),
            (select count(*) from fact_delta),
            (select count(*) from fact_after where outcome in ('INSERT', 'UPDATE'))""",
        "stream_audit_listing": f"""select 1 as run, {AUDIT_COUNTS} from ({flagged()})
            where duplicate_ind or conflict_ind or parse_fail_ind
            union all select 2, {AUDIT_COUNTS} from ({flagged('delta')})
            where duplicate_ind or conflict_ind or parse_fail_ind""",
        "running_balance_kept": f"""select transaction_id, facility_id, transaction_date, amount,
            facility_balance from ({RUNNING.format(fact='fact_after')})""",
        "audit_listing": " union all ".join(f"""select {run} as run, transaction_id, record_number,
            duplicate_ind, conflict_ind, parse_fail_ind, parse_fail_fields from ({flagged(source)})
            where duplicate_ind or conflict_ind or parse_fail_ind"""
            for run, source in ((1, "led"), (2, "delta"))),
        "crm_files": f"select {', '.join(CRM_FIELDS)}, true as traced from raw_crm",
        "facility_files": f"select {', '.join(FACILITY_FIELDS)}, true as traced from raw_fac",
        "intake_to_fact": f"""select 'API-' || md5(request_id) as transaction_id,
            known_id as facility_id, d as transaction_date, cast(a as decimal(35,3)) as amount,
            case upper(share_class) when 'CLASS A' then 'Class A' when 'CLASS B' then 'Class B' end
            as share_class, known_fund as fund_description, true as known_facility_ind
            from ({REQUESTS}) where rejection_code is null""",
        "layer_counts": f"""select 'raw' as layer, count(*) as n from raw_led
            union all select 'staged', count(*) from staged union all select 'fact', count(*) from fact
            union all select 'fact_distinct_ids', count(distinct transaction_id) from fact
            union all select 'audit', count(*) from ({AUDITED_TXN})""",
        "row_conservation": f"""select count(*) as raw_rows,
            count(*) filter (where parse_fail_fields <> '') as quarantined,
            count(*) filter (where parse_fail_fields = '') as staged_copies,
            case when count(*) = count(*) filter (where parse_fail_fields <> '')
                + (select count(*) from led where parse_fail_fields = ''
                   and transaction_id in (select transaction_id from staged))
                then 'PASS' else 'FAIL' end as result from led""",
        "ri_check": integrity(),
        "join_fan_out": """select facility_rows + 1 as facility_rows, joined_rows + 1 as joined_rows,
            matched_rows + 1 as matched_rows,
            case when joined_rows = matched_rows then 'PASS' else 'FAIL' end as result from (
            select (select count(*) from dim) as facility_rows,
            (select count(*) from dim join borrower using (organization_sk)) as joined_rows,
            (select count(*) from dim where organization_sk in
                (select organization_sk from borrower)) as matched_rows)""",
        "provenance_counts": """select source_system, count(*) as organizations from org
            group by 1""",
        "collapsed_names": f"""select source_system, name, match_key, distinct_source_names from (
            select *, {key('name')} as match_key from (
                select distinct 'CRM' as source_system, upper(trim(org_name)) as name from raw_crm
                union select distinct 'SERVICING', upper(trim(client_name)) from raw_fac))
            join (select {key('name')} as match_key, count(distinct name) as distinct_source_names
                  from (select upper(trim(org_name)) as name from raw_crm
                        union all select upper(trim(client_name)) from raw_fac)
                  group by 1 having count(distinct name) > 1) using (match_key)""",
        "total_outstanding": """select count(*) as total_facilities,
            count(*) - count(net_funds_employed) as facilities_missing_balance,
            sum(net_funds_employed) as total_outstanding from dim""",
        "outstanding_by_status": f"""select coalesce(status, 'UNKNOWN') as status,
            count(*) as facilities, sum(net_funds_employed) as outstanding,
            {pct('sum(net_funds_employed)', '(select sum(net_funds_employed) from dim)')}
            as pct_of_total from dim group by 1""",
        "blank_balances": f"""select facility_id, stated_balance, d.status,
            d.net_funds_employed as current_balance
            from (select distinct facility_id, stated_balance from raw_fac) r
            join dim d using (facility_id) where {money('stated_balance')} is null""",
        "orphan_recon": """select count(*) as orphan_transactions,
            count(distinct facility_id) as orphan_facility_ids, sum(amount) as orphan_amount
            from fact where not known_facility_ind""",
        "orphan_facilities": """select facility_id, count(*) as transactions,
            sum(amount) as amount from fact where not known_facility_ind group by 1""",
        "top_borrowers": f"""select organization_id, organization_name,
            count(*) as open_facilities, sum(net_funds_employed) as exposure,
            {pct('sum(net_funds_employed)',
                 f'(select sum(net_funds_employed) from dim where {OPEN})')} as pct_of_open_book,
            {pct('sum(net_funds_employed)', '(select sum(net_funds_employed) from dim)')}
            as pct_of_portfolio
            from dim join borrower using (organization_sk)
            where {OPEN} and source_system <> 'SYNTHETIC' group by 1, 2
            order by exposure desc nulls last, organization_id limit 5""",
        "excluded_exposure": f"""select coalesce(status, 'UNKNOWN') as status,
            count(*) as facilities, sum(net_funds_employed) as excluded_exposure from dim
            where not coalesce({OPEN}, false) group by 1""",
        "excluded_facilities": f"""select coalesce(status, 'UNKNOWN') as status, facility_id,
            net_funds_employed from dim where not coalesce({OPEN}, false)""",
        "monthly_remittances": f"""select month_start, fund_description,
            count(amount) as remittances, coalesce(sum(amount), 0) as remittance_total
            from (select cast(unnest(generate_series(date '{YEAR}-01-01', date '{YEAR}-12-01',
                  interval 1 month)) as date) as month_start)
            cross join (select fund_description from dim union select fund_description from fact
                        where transaction_type = 'Remittance' and {IN_YEAR}) funds
            left join (select date_trunc('month', transaction_date) as m,
                       fund_description as f, amount from fact
                       where transaction_type = 'Remittance' and {IN_YEAR})
                 on m = month_start and f is not distinct from fund_description
            group by 1, 2""",
        "year_totals": f"""select fund_description, count(*) as remittances,
            sum(amount) as remittance_total from fact
            where transaction_type = 'Remittance' and {IN_YEAR} group by 1""",
        "orphan_remittances": f"""select transaction_id, transaction_date, facility_id,
            fund_description as ledger_fund, amount from fact
            where transaction_type = 'Remittance' and {IN_YEAR} and not known_facility_ind""",
        "raw_name_loss": """select count(*) as facilities, count(n) as matched_on_raw_name,
            count(*) - count(n) as lost_to_the_join from
            (select distinct facility_id, upper(trim(client_name)) as c from raw_fac)
            left join (select distinct upper(trim(org_name)) as n from raw_crm) on n = c""",
        "exposure_by_industry": f"""select industry,
            count(distinct case when source_system <> 'SYNTHETIC' then organization_sk end)
            as borrowers, count(*) as facilities, sum(net_funds_employed) as exposure,
            sum(case when {OPEN} then net_funds_employed else 0 end) as open_exposure,
            {pct('sum(net_funds_employed)', '(select sum(net_funds_employed) from dim)')}
            as pct_of_portfolio from labelled group by 1""",
        "unmapped_borrowers": """select organization_name, source_system, count(*) as facilities,
            sum(net_funds_employed) as exposure from dim left join org using (organization_sk)
            where source_system = 'SERVICING' or industry is null group by 1, 2""",
        "recon_checks": reconciliations(),
        "outside_year_latest": f"""select transaction_id, transaction_date, facility_id, amount
            from fact where transaction_type = 'Remittance' and not {IN_YEAR}
            order by transaction_date desc, transaction_id limit 10""",
        "investor_summary": investor_summary(),
        "privacy_check": f"""select *, case when summary_total = mart_total
            and smallest_cell_facilities > 1 then 'PASS' else 'FAIL' end as result from (
            select max(outstanding_balance) filter (where metric_group = 'PORTFOLIO')
                as summary_total,
            min(facility_count) filter (where metric_group in ('FUND', 'POSITION STATUS'))
                as smallest_cell_facilities,
            (select sum(net_funds_employed) from dim) as mart_total
            from ({investor_summary()}))""",
        "open_share": f"""select sum(case when {OPEN} then net_funds_employed end) as open_book,
            sum(net_funds_employed) as portfolio, {pct(
                f'sum(case when {OPEN} then net_funds_employed end)', 'sum(net_funds_employed)')}
            as open_pct_of_portfolio from dim""",
        "api_borrower": """select organization_id, organization_name, industry, state,
            relationship_owner from borrower where organization_id <> 'NULL ORGANIZATION'""",
        "api_loan": """select facility_id, organization_id, organization_name, industry,
            fund_description, product_type, status, net_funds_employed, facility_funding_limit,
            discount_rate, funding_date, maturity_date from loan""",
        "serving_check": """select 'loan' as view_name, count(*) as row_count,
            count(organization_id) as mapped_to_borrower from loan union all
            select 'borrower', count(*), count(*) from org""",
        "loan_page": f"""select facility_id, organization_id, organization_name, industry,
            fund_description, product_type, status, net_funds_employed, facility_funding_limit,
            discount_rate, funding_date, maturity_date, count(*) over () as total from loan
            where status = 'ACTIVE' and fund_description = '{demo.TERM}'
            order by facility_id limit 50 offset 100""",
        "borrower_loans": """select organization_id, organization_name, facility_id, status,
            net_funds_employed from org left join dim using (organization_sk)
            where organization_id = 'CRM-000000000001'""",
        "loans_per_borrower": """select organization_id, organization_name,
            count(facility_id) as loans, coalesce(sum(net_funds_employed), 0) as outstanding
            from org left join dim using (organization_sk) group by 1, 2""",
        "portfolio_summary": portfolio_summary(),
        "remittance_intake": f"""select request_id, facility_id, amount, transaction_date,
            case when rejection_code is null then 'accepted' else 'rejected' end as disposition,
            rejection_code from ({REQUESTS})""",
        "accepted_remittances": f"""select 'API-' || md5(request_id) as transaction_id,
            strftime(d, '%d-%b-%y') as transaction_date, known_fund as fund,
            case upper(share_class) when 'CLASS A' then 'Class A' when 'CLASS B' then 'Class B' end
            as share_class, known_id as investment_ref, 'Remittance' as transaction_type,
            cast(a as varchar) as amount, 'api://remittances' as file_name,
            cast('0x' || substr(md5(request_id), 1, 15) as bigint) as file_row_number,
            {RUN} as file_last_modified
            from ({REQUESTS}) where rejection_code is null""",
        "closed_receipts": """select facility_id, count(*) as remittances,
            sum(amount) as remittance_total from fact where transaction_type = 'Remittance'
            and facility_id in (select facility_id from dim where status = 'CLOSED')
            group by 1""",
    }
    # the same rows, reached in another way
    sql |= {"raw_feed_fact": sql["stream_fact"], "raw_feed_runs": sql["stream_run_summary"],
            "nfe_movement_as_of": sql["nfe_movement"]}
    return {name: q(text) for name, text in sql.items()}
