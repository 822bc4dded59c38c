"""The library's queries over the dirty exports that ``demo`` derives from the test tables.

Every entry takes a session and the folder of the test tables.
"""

from functools import cached_property

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import demo
from .functions import (
    accounting_amount, any_date, currency, ledger_date, match_key, rate, short_us_date,
    status_code,
)
from .functions.keys import packed
from .model import (
    CRM_FIELDS, DIM_FACILITY, DIM_ORGANIZATION, FACILITY_FIELDS, FACT, LEDGER_FIELDS, as_stored,
    empty,
)
from .operators.balances import correct_balances, net_funds, running_balance
from .operators.scd2 import scd2_merge
from .operators.upsert import upsert_outcomes
from .plans import intake, portfolio, quality, serving
from .plans.facilities import (
    agreed_facilities, facilities, facility_audit, facility_conflicts,
)
from .plans.marts import (
    BuiltMarts, Marts, current_members, facility_guard, fact_source, first_corrected,
    first_facilities, first_fact, load_fact, load_organizations, organization_guard,
    resolve_orphans, spelled_out, stored_source,
)
from .plans.organizations import crm_organizations, organization_audit, organizations
from .plans.transactions import (
    absent_only, audit_transactions, flag_transactions, parse_transactions, resolve_transactions,
)
from .session import shared_dir
from .sources.exports import file_fingerprints, load_once, read_export, write_export
from .sources.published import PublishedTables
from .streaming.incremental import LedgerPipeline

SECOND_RUN = "2026-02-01 06:00:00"
TODAY = "2026-01-15"


class Book:
    """The raw exports of one folder and what the pipeline makes of them, lazily."""

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def crm(self):
        return stored_raw(self, "crm", demo.crm_raw)

    @cached_property
    def fac(self):
        return stored_raw(self, "fac", demo.facility_raw)

    @cached_property
    def led(self):
        return stored_raw(self, "led", demo.ledger_raw)

    @cached_property
    def delta(self):
        return stored_raw(self, "delta", demo.ledger_delta)

    @cached_property
    def requests(self):
        return demo.requests(self.spark, self.sf_dir)

    @cached_property
    def built(self):
        """The marts as plans over the raw exports."""
        return BuiltMarts(self, demo.RUN_TS, demo.ALIASES)

    @cached_property
    def marts(self):
        """The marts as published tables, built when a session first asks for them."""
        return published_marts(self)

    @cached_property
    def parsed(self):
        return parse_transactions(self.led, demo.ALIASES)

    @property
    def staged(self):
        return self.built.staged

    @property
    def stated(self):
        return self.built.stated

    @property
    def fact(self):
        return self.marts.fact

    @cached_property
    def source(self):
        return fact_source(self.staged, self.stated, self.led)

    @cached_property
    def delta_source(self):
        staged = resolve_transactions(parse_transactions(self.delta, demo.ALIASES))
        return fact_source(staged, self.marts.facility, self.delta)

    def second_exports(self):
        """The next full exports, in which the duplicate copies are gone."""
        return (self.crm.filter("file_name = 'crm_export.csv'"),
                self.fac.filter("file_name = 'facilities_0.csv'"))


_raw = {}


def stored_raw(book, name, export):
    """A raw table, loaded when a session first asks for it: RAW is stored, and read often."""
    place = (book.spark.sparkContext.applicationId, book.sf_dir, name)
    if place not in _raw:
        rows = export(book.spark, book.sf_dir)
        folder = shared_dir(book.spark, f"raw-{name}")
        rows.write.option("compression", "zstd").parquet(folder)
        _raw[place] = (folder, rows.schema)
    folder, schema = _raw[place]
    return book.spark.read.schema(schema).parquet(folder)


_published = {}


def publish_marts(book):
    """Build the marts from the raw exports and write them; the full rebuild."""
    tables = PublishedTables(book.spark, shared_dir(book.spark, "marts"), {
        "organization": DIM_ORGANIZATION, "facility": DIM_FACILITY, "fact": as_stored(FACT),
    })
    built = book.built
    agreed = tables.write("agreed", "rebuild", agreed_facilities(book.fac))
    stated = first_facilities(agreed, demo.RUN_TS)
    source = stored_source(built.staged, stated, book.led)
    fact = spelled_out(tables.write("fact", "rebuild", first_fact(source, demo.RUN_TS)))
    tables.write("organization", "rebuild", built.organization)
    tables.write("facility", "rebuild", first_corrected(agreed, fact, demo.RUN_TS))
    tables.commit("rebuild", replaced=["organization", "facility", "fact"])
    return tables


def published_marts(book):
    place = (book.spark.sparkContext.applicationId, book.sf_dir)
    if place not in _published:
        _published[place] = publish_marts(book)
    tables = _published[place]
    organization, facility, fact = [
        tables.read(t).drop("seq") for t in ("organization", "facility", "fact")]
    return Marts(organization, facility, spelled_out(fact))


def parse_amount(b):
    return b.led.select("file_name", "file_row_number", F.col("amount").alias("amount_text"),
                        accounting_amount(F.col("amount")).alias("amount_value"))


def parse_dates(b):
    def counted(df, kind, column, parse):
        return df.groupBy(F.col(column).alias("date_text")).agg(F.count("*").alias("n")).select(
            F.lit(kind).alias("kind"), "date_text", parse(F.col("date_text")).alias("date_value"),
            "n")

    return (
        counted(b.fac, "funding", "funding_date", any_date)
        .unionByName(counted(b.fac, "maturity", "maturity_date", any_date))
        .unionByName(counted(b.led, "ledger", "transaction_date", ledger_date))
        .unionByName(counted(b.crm, "crm", "date_added", short_us_date))
    )


def parse_rate(b):
    return b.fac.select(
        "file_name", "file_row_number", F.col("discount_rate").alias("rate_text"),
        rate(F.col("discount_rate")).alias("rate_value"),
        F.col("facility_limit").alias("limit_text"),
        currency(F.col("facility_limit")).alias("limit_value"),
    )


def normalize_status(b):
    return b.fac.groupBy(F.col("status").alias("status_text")).agg(
        F.count("*").alias("n")
    ).select("status_text", status_code(F.col("status_text")).alias("status_code"), "n")


def match_keys(b):
    def counted(df, column):
        return df.groupBy(F.col(column).alias("name")).agg(F.count("*").alias("n"))

    return counted(b.crm, "org_name").unionByName(counted(b.fac, "client_name")).select(
        "name", match_key(F.col("name")).alias("match_key"), "n"
    )


def file_provenance(b):
    """Write the ledger as CSV, read it back, and check the numbers rows got."""
    folder = shared_dir(b.spark, "ledger-csv")
    write_export(b.led, LEDGER_FIELDS, folder)
    rows = read_export(b.spark, folder, LEDGER_FIELDS, "*.csv")
    per_file = rows.groupBy("file_name").agg(
        F.count("*").alias("n"), F.countDistinct("file_row_number").alias("numbers"),
        F.min("file_row_number").alias("low"), F.max("file_row_number").alias("high"),
    )
    sound = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("numbers") == F.col("n"))
    return per_file.agg(
        F.sum("n").alias("raw_rows"), F.sum("numbers").alias("numbered_rows"),
        F.bool_and(sound).alias("every_file_numbered_from_one"),
    )


def load_once_query(b):
    """The ledger arrives again with new files beside the known ones: only those load."""
    known = file_fingerprints(b.led.filter("file_name like 'ledger-%'"), LEDGER_FIELDS)
    fresh = load_once(b.led, known, LEDGER_FIELDS)
    return fresh.select("transaction_id", "file_name", "file_row_number")


def txn_parsed(b):
    return b.parsed.select(
        "file_name", "file_row_number", "transaction_id", "transaction_date_raw", "amount_raw",
        "transaction_date", "fund_description", "share_class", "facility_id",
        "transaction_type", "amount", "parse_fail_fields",
    )


def txn_flags(b):
    flagged = flag_transactions(b.parsed)
    flags = [c for c in flagged.columns if c.endswith("conflict_ind")]
    return flagged.select(
        "file_name", "file_row_number", "transaction_id", "record_number", "duplicate_ind",
        *flags, "parse_fail_ind", "parse_fail_fields",
    )


def txn_newest_delivery(b):
    both = parse_transactions(b.led.unionByName(b.delta), demo.ALIASES)
    return resolve_transactions(both, "file_last_modified")


def txn_audit(b):
    return audit_transactions(b.parsed, demo.RUN_TS)


def audit_append(b):
    """The audit after the same batch was audited twice."""
    once = audit_transactions(b.parsed, demo.RUN_TS)
    return once.unionByName(absent_only(audit_transactions(b.parsed, SECOND_RUN), once))


def scd2_initial(b):
    return load_organizations(None, organizations(b.crm, b.fac), demo.RUN_TS)


def scd2_second_run(b):
    first = scd2_merge(empty(b.spark, DIM_FACILITY), facilities(b.fac), "facility_sk",
                       demo.RUN_TS)
    return scd2_merge(first, facilities(b.second_exports()[1]), "facility_sk", SECOND_RUN)


def scd2_second_run_organizations(b):
    first = scd2_merge(empty(b.spark, DIM_ORGANIZATION), organizations(b.crm, b.fac),
                       "organization_sk", demo.RUN_TS)
    return scd2_merge(first, organizations(*b.second_exports()), "organization_sk", SECOND_RUN)


def guard_rows(b):
    """Guards of both dimensions after two loads, with the real members beside them."""
    def line(dimension, rows, key, member, guard):
        twice = rows.unionByName(
            guard.join(rows.select(key), key, "left_anti").select(*rows.columns)
        )
        is_guard = F.startswith(F.col(member), F.lit("NULL "))
        return twice.agg(
            F.max(F.when(is_guard, F.col(key))).alias("sk"),
            F.max(F.when(is_guard, F.col(member))).alias("member_id"),
            F.count_if(~is_guard).alias("members"),
        ).select(F.lit(dimension).alias("dimension"), "sk", "member_id", "members")

    return line(
        "organization", scd2_initial(b), "organization_sk", "organization_id",
        organization_guard(b.spark, SECOND_RUN),
    ).unionByName(line("facility", b.stated, "facility_sk", "facility_id",
                       facility_guard(b.spark, SECOND_RUN)))


def outcomes_of(b, source):
    """What becomes of every id; only what tells versions apart is compared, as bytes."""
    told = ["transaction_id", packed(F.col("change_tracking_key")).alias("change_tracking_key")]
    return upsert_outcomes(b.fact.select(*told, "record_inserted_ts", "record_updated_ts"),
                           source.select(*told), "transaction_id", SECOND_RUN)


def orphan_reresolution(b):
    """The ledger loads when only one fund's facilities are known; then the rest arrive."""
    partial = b.stated.filter((F.col("fund_description") != demo.RECEIVABLES)
                                | F.col("fund_description").isNull())
    early = first_fact(fact_source(b.staged, partial, b.led), demo.RUN_TS)
    return resolve_orphans(early, b.stated).select(
        "transaction_id", "facility_sk", "fund_description", "change_tracking_key"
    )


def running_balance_query(b):
    return running_balance(b.fact).select(
        "transaction_id", "facility_id", "transaction_date", "amount", "facility_balance"
    )


def balance_correction(b):
    stated = b.stated
    now = correct_balances(stated, net_funds(b.fact))
    before = stated.select("facility_id", F.col("net_funds_employed").alias("stated_balance"))
    return current_members(now).join(before, "facility_id").select(
        "facility_id", "stated_balance", "net_funds_employed"
    )


def nfe_movement(b):
    """Balances before and after the second delivery."""
    stated = b.stated
    before = correct_balances(stated, net_funds(b.fact))
    after_fact = load_fact(b.fact, b.delta_source, SECOND_RUN)
    after = correct_balances(stated, net_funds(after_fact))
    return quality.balance_movement(current_members(before), after)


def stream_incremental(b):
    """Two deliveries of CSV files through the streaming pipeline; balances at the end."""
    root = shared_dir(b.spark, "ledger-stream")
    job = LedgerPipeline(b.spark, f"{root}/tables", demo.ALIASES, buckets=16)
    job.load_dimensions("dims-1", b.crm, b.fac, demo.RUN_TS)
    for delivery in (b.led, b.delta):
        write_export(delivery, LEDGER_FIELDS, f"{root}/landing")
        job.run(f"{root}/landing", f"{root}/checkpoint", SECOND_RUN, "*.csv")
    return current_members(job.marts().facility).select("facility_id", "net_funds_employed")


def from_shared_folder(b, kind):
    """All three exports written into one folder; one of them picked by name and read back."""
    exports = {"crm": (b.crm, CRM_FIELDS), "fac": (b.fac, FACILITY_FIELDS),
               "led": (b.led, LEDGER_FIELDS)}
    folder = shared_dir(b.spark, "exports")
    for ending, (rows, fields) in exports.items():
        write_export(rows, fields, folder, ending)
    fields = exports[kind][1]
    rows = read_export(b.spark, folder, fields, f"*.{kind}")
    return rows.select(*fields, (F.col("file_last_modified").isNotNull()
                                 & (F.col("file_row_number") > 0)).alias("traced"))


_streamed = {}


def streamed(b):
    """The pipeline after two deliveries, run when a session first asks for it."""
    place = (b.spark.sparkContext.applicationId, b.sf_dir)
    if place not in _streamed:
        _streamed[place] = stream_deliveries(b)
    return _streamed[place]


def in_files(rows, least):
    """The rows in ``least`` files or more: as they lie, if they are read by as many tasks."""
    return rows if rows.rdd.getNumPartitions() >= least else rows.repartition(least)


def stream_deliveries(b):
    """Two deliveries through the streaming pipeline, the first in several files."""
    root = shared_dir(b.spark, "ledger-state")
    job = LedgerPipeline(b.spark, f"{root}/tables", demo.ALIASES, buckets=16)
    job.load_dimensions("dims-1", b.crm, b.fac, demo.RUN_TS)
    for delivery in (in_files(b.led, 5), b.delta):
        write_export(delivery, LEDGER_FIELDS, f"{root}/landing")
        job.run(f"{root}/landing", f"{root}/checkpoint", SECOND_RUN, "*.csv")
    return job


def stream_fact(b):
    """The streamed fact, less the times of its runs."""
    return streamed(b).fact().drop("record_inserted_ts", "record_updated_ts")


def run_summary(job):
    """What each run took in and wrote, by order of the runs."""
    metrics = job.tables.read("metrics")
    run = F.dense_rank().over(Window.partitionBy("metric").orderBy("seq"))
    return metrics.withColumn("run", run).groupBy("run").pivot(
        "metric", ["batch", "audited", "staged", "fact"]).agg(F.first("n")).withColumnRenamed(
        "fact", "changed")


def stream_run_summary(b):
    return run_summary(streamed(b))


_fed = {}


def fed(b):
    """The pipeline after two deliveries through RAW, run when a session first asks for it."""
    place = (b.spark.sparkContext.applicationId, b.sf_dir)
    if place not in _fed:
        _fed[place] = feed_deliveries(b)
    return _fed[place]


def feed_deliveries(b):
    """Two deliveries, each appended to RAW in two parts by two writers and then taken up.

    Every append and every run is repeated, as after a crash, and an empty run follows.
    """
    root = shared_dir(b.spark, "ledger-feed")
    first, second = (LedgerPipeline(b.spark, f"{root}/tables", demo.ALIASES, buckets=16)
                     for _ in range(2))
    first.load_dimensions("dims-1", b.crm, b.fac, demo.RUN_TS)
    own = F.pmod(F.xxhash64("file_name"), F.lit(2)) == 0
    for turn, delivery in enumerate((b.led, b.delta), 1):
        for _ in range(2):
            first.append(f"files-{turn}", delivery.filter(own))
            second.append(f"inserted-{turn}", delivery.filter(~own), force=True)
        for job, run in ((second, "run"), (first, "run"), (first, "empty")):
            job.advance(f"{run}-{turn}", SECOND_RUN)
    return second


def raw_feed_fact(b):
    """The fact from RAW as two writers filled it, less the times of its runs."""
    return fed(b).fact().drop("record_inserted_ts", "record_updated_ts")


def nfe_movement_as_of(b):
    """Balances as stored after the first delivery, against those after the second."""
    job = fed(b)
    first_run = job.tables.read("metrics").agg(F.min("seq")).first()[0]
    return quality.balance_movement(
        current_members(job.marts(first_run).facility), job.marts().facility)


def running_balance_kept(b):
    """Running balances after the second delivery, from the movements of both."""
    return fed(b).running_balances().select(
        "transaction_id", "facility_id", "transaction_date", "amount", "facility_balance")


def audit_listing(b):
    """Every audited record by run, id and copy; sorted by ranges, whatever their number."""
    audit = fed(b).tables.read("audit")
    runs = audit.select("seq").distinct().withColumn(  # one row per run
        "run", F.row_number().over(Window.orderBy("seq")))
    return audit.join(F.broadcast(runs), "seq").select(
        "run", "transaction_id", "record_number", "duplicate_ind", "conflict_ind",
        "parse_fail_ind", "parse_fail_fields",
    ).orderBy("run", "transaction_id", "record_number")


def stream_audit_counts(b):
    """What each run put into the audit, by order of the runs."""
    audit = streamed(b).tables.read("audit")
    per_load = audit.groupBy("seq").agg(
        F.count("*").alias("listed"), F.count_if("duplicate_ind").alias("duplicates"),
        F.count_if("conflict_ind").alias("conflicts"),
        F.count_if("parse_fail_ind").alias("unreadable"))
    # one row per load
    return per_load.withColumn("run", F.row_number().over(Window.orderBy("seq"))).drop("seq")


def intake_to_fact(b):
    """Accepted requests in the fact, after every request was submitted twice."""
    root = shared_dir(b.spark, "intake")
    job = LedgerPipeline(b.spark, f"{root}/tables", demo.ALIASES, buckets=16)
    job.load_dimensions("dims-1", b.crm, b.fac, demo.RUN_TS)
    for turn in (1, 2):
        job.submit(f"requests-{turn}", b.requests, TODAY, SECOND_RUN)
    return job.fact().select("transaction_id", "facility_id", "transaction_date", "amount",
                             "share_class", "fund_description", "known_facility_ind")


def full_rebuild(b):
    """All marts rebuilt from the raw exports and written; rows per table."""
    tables = publish_marts(b)
    lines = [tables.read(t).agg(F.count("*").alias("rows"))
             .select(F.lit(t).alias("table_name"), "rows")
             for t in ("organization", "facility", "fact")]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def layer_counts(b):
    return quality.layer_counts(b.led, b.staged, b.fact, txn_audit(b))


def row_conservation(b):
    return quality.row_conservation(b.parsed)


def dq_log(b):
    return quality.quality_log(b.crm, b.fac, b.led, b.marts, facilities(b.fac), demo.ALIASES,
                               b.delta)


def ri_check(b):
    return quality.integrity_checks(b.marts, organizations(b.crm, b.fac), facilities(b.fac))


def accepted_remittances(b):
    return intake.accepted_rows(b.requests, serving.api_loan(b.marts), TODAY, demo.RUN_TS)


QUERIES = {
    # column functions
    "parse_amount": parse_amount,
    "parse_dates": parse_dates,
    "parse_rate": parse_rate,
    "normalize_status": normalize_status,
    "match_key": match_keys,
    "row_hash": lambda b: facilities(b.fac).select(
        "facility_id", "facility_sk", "change_tracking_key"),
    # sources
    "file_provenance": file_provenance,
    "load_once": load_once_query,
    "crm_files": lambda b: from_shared_folder(b, "crm"),
    "facility_files": lambda b: from_shared_folder(b, "fac"),
    # staging
    "org_dedup": lambda b: crm_organizations(b.crm),
    "org_conformed": lambda b: organizations(b.crm, b.fac),
    "org_audit": lambda b: organization_audit(b.crm),
    "facility_clean": lambda b: facilities(b.fac),
    "facility_conflicts": lambda b: facility_conflicts(b.fac).drop("usable_copies"),
    "facility_audit": lambda b: facility_audit(b.fac),
    "txn_parsed": txn_parsed,
    "txn_flags": txn_flags,
    "txn_resolved": lambda b: b.staged,
    "txn_newest_delivery": txn_newest_delivery,
    "txn_audit": txn_audit,
    "audit_append": audit_append,
    "dq_log": dq_log,
    # marts
    "scd2_initial": scd2_initial,
    "scd2_second_run": scd2_second_run,
    "scd2_second_run_organizations": scd2_second_run_organizations,
    "guard_rows": guard_rows,
    "fact_resolved": lambda b: b.source,
    "fact_upsert": lambda b: load_fact(b.fact, b.delta_source, SECOND_RUN),
    "upsert_outcomes": lambda b: outcomes_of(b, b.delta_source).select(
        "transaction_id", "outcome"),
    "fact_resend_noop": lambda b: outcomes_of(b, b.source).groupBy("outcome").agg(
        F.count("*").alias("n")),
    "orphan_reresolution": orphan_reresolution,
    "running_balance": running_balance_query,
    "full_rebuild": full_rebuild,
    "net_funds": lambda b: net_funds(b.fact),
    "balance_correction": balance_correction,
    "nfe_movement": nfe_movement,
    "stream_incremental": stream_incremental,
    "stream_fact": stream_fact,
    "stream_run_summary": stream_run_summary,
    "stream_audit_listing": stream_audit_counts,
    "raw_feed_fact": raw_feed_fact,
    "raw_feed_runs": lambda b: run_summary(fed(b)),
    "nfe_movement_as_of": nfe_movement_as_of,
    "running_balance_kept": running_balance_kept,
    "audit_listing": audit_listing,
    "intake_to_fact": intake_to_fact,
    # checks
    "layer_counts": layer_counts,
    "row_conservation": row_conservation,
    "ri_check": ri_check,
    "join_fan_out": lambda b: quality.join_fan_out(b.marts),
    "provenance_counts": lambda b: quality.provenance_counts(organizations(b.crm, b.fac)),
    "collapsed_names": lambda b: quality.collapsed_names(b.crm, b.fac),
    "recon_checks": lambda b: quality.reconciliations(b.marts, demo.YEAR),
    "privacy_check": lambda b: quality.privacy_check(b.marts),
    "open_share": lambda b: quality.open_share(b.marts),
    "serving_check": lambda b: quality.serving_check(b.marts),
    "closed_receipts": lambda b: quality.closed_receipts(b.marts),
    # portfolio
    "total_outstanding": lambda b: portfolio.total_outstanding(b.marts),
    "outstanding_by_status": lambda b: portfolio.outstanding_by_status(b.marts),
    "blank_balances": lambda b: portfolio.blank_balances(b.fac, b.marts),
    "orphan_recon": lambda b: portfolio.orphan_totals(b.marts),
    "orphan_facilities": lambda b: portfolio.orphan_facilities(b.marts),
    "top_borrowers": lambda b: portfolio.top_borrowers(b.marts),
    "excluded_exposure": lambda b: portfolio.excluded_exposure(b.marts),
    "excluded_facilities": lambda b: portfolio.excluded_facilities(b.marts),
    "monthly_remittances": lambda b: portfolio.monthly_remittances(b.marts, demo.YEAR),
    "year_totals": lambda b: portfolio.year_totals(b.marts, demo.YEAR),
    "orphan_remittances": lambda b: portfolio.orphan_remittances(b.marts, demo.YEAR),
    "raw_name_loss": lambda b: portfolio.raw_name_loss(b.crm, b.fac),
    "exposure_by_industry": lambda b: portfolio.exposure_by_industry(b.marts),
    "unmapped_borrowers": lambda b: portfolio.unmapped_borrowers(b.marts),
    "outside_year_latest": lambda b: portfolio.outside_year(b.marts, demo.YEAR),
    "investor_summary": lambda b: portfolio.investor_summary(b.marts),
    # serving
    "api_borrower": lambda b: serving.api_borrower(b.marts),
    "api_loan": lambda b: serving.api_loan(b.marts),
    "loan_page": lambda b: serving.loan_page(b.marts, "active", demo.TERM.upper(), 50, 100),
    "borrower_loans": lambda b: serving.borrower_loans(b.marts, "crm-000000000001"),
    "loans_per_borrower": lambda b: serving.loans_per_borrower(b.marts),
    "portfolio_summary": lambda b: serving.portfolio_summary(b.marts),
    "remittance_intake": lambda b: intake.request_outcomes(
        b.requests, serving.api_loan(b.marts), TODAY),
    "accepted_remittances": accepted_remittances,
}
