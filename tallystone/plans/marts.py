"""Dimensions and the transaction fact."""

from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import row_hash, surrogate_key
from ..functions.keys import LEFT_OUT, packed, unpacked
from ..model import (
    DIM_FACILITY, DIM_ORGANIZATION, END_OF_TIME, FACILITY, FACT, FACT_SOURCE, FROM_NOWHERE,
    NO_FACILITY, NO_ORGANIZATION, REMITTANCE,
)
from ..operators.balances import (
    correct_balances, ledger_replaces, net_funds, net_funds_of_staged, with_ledger,
)
from ..operators.conflicts import written
from ..operators.scd2 import first_versions, scd2_changes, scd2_merge, with_guard
from ..operators.skew import salted_lookup, sizes_of_heavy
from ..operators.upsert import upsert
from .facilities import facilities, keyed_facilities
from .organizations import organizations
from .transactions import parse_transactions, resolve_transactions

HASHED = FACT_SOURCE.fieldNames()[:-1]
#: Keys of a version of a transaction, and the columns whose digests they are as a rule.
KEYS = {"transaction_sk": "transaction_id", "facility_sk": "facility_id",
        "old_facility_sk": "old_facility_id"}


def _guard_row(spark, schema, label, texts, run_ts):
    """The member that stands for "unknown": its label in the given columns."""
    fixed = {
        "record_version_number": "1",
        "is_current_ind": "true",
        "record_valid_from_ts": f"'{run_ts}'",
        "record_valid_to_ts": f"'{END_OF_TIME}'",
        "source_system": f"'{FROM_NOWHERE}'",
        "organization_sk": f"md5('{NO_ORGANIZATION}')",
        "facility_sk": f"md5('{NO_FACILITY}')",
        "change_tracking_key": f"md5('{label}')",
        "scd_id": f"md5(md5('{label}') || '||1')",
        **{c: f"'{label}'" for c in texts},
    }
    return spark.range(1).selectExpr(*[
        f"cast({fixed.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
        for f in schema.fields
    ])


def organization_guard(spark, run_ts):
    texts = ["organization_id", "organization_name", "industry", "state", "relationship_owner"]
    return _guard_row(spark, DIM_ORGANIZATION, NO_ORGANIZATION, texts, run_ts)


def facility_guard(spark, run_ts):
    texts = ["facility_id", "fund_description", "product_type", "status"]
    return _guard_row(spark, DIM_FACILITY, NO_FACILITY, texts, run_ts)


def _load(dimension, staged, key, guard, run_ts):
    if dimension is None:
        loaded = first_versions(staged, key, run_ts)
        return loaded.unionByName(guard)
    return with_guard(scd2_merge(dimension, staged, key, run_ts), guard, key)


def load_organizations(dimension, staged, run_ts):
    """The dimension after a load; ``None`` stands for a dimension that does not exist yet."""
    guard = organization_guard(staged.sparkSession, run_ts)
    return _load(dimension, staged, "organization_sk", guard, run_ts)


def load_facilities(dimension, staged, run_ts):
    guard = facility_guard(staged.sparkSession, run_ts)
    return _load(dimension, staged, "facility_sk", guard, run_ts)


def first_facilities(agreed, run_ts):
    """The dimension after its first load, from the agreed values of every facility."""
    staged = keyed_facilities(agreed).select(*FACILITY.fieldNames())
    return load_facilities(None, staged, run_ts)


def first_corrected(agreed, fact, run_ts):
    """The same with the balances the ledger shows.

    Values meet balances by facility id before keys and hashes are worked out from them: four
    digests a row, which do not compress, stay out of the shuffle.
    """
    owner = "organization_sk"
    met = with_ledger(agreed.withColumn(owner, packed(F.col(owner))),
                      net_funds(fact, "facility_id"), "facility_id")
    staged = keyed_facilities(met.withColumn(owner, unpacked(F.col(owner))))
    loaded = first_versions(staged, "facility_sk", run_ts)
    return ledger_replaces(loaded, DIM_FACILITY.fieldNames()).unionByName(
        facility_guard(agreed.sparkSession, run_ts))


def dimension_changes(current, staged, key, guard, run_ts):
    """The rows a load adds to a dimension of which ``current`` holds the open versions: what
    it opens and closes, and the guard member if that is missing."""
    missing = guard.join(current.select(key), key, "left_anti")
    return scd2_changes(current, staged, key, run_ts).unionByName(
        missing.select(*current.columns))


def current_members(dimension, key="facility_id", guard=NO_FACILITY):
    """Current versions without the guard member."""
    return dimension.filter(F.col("is_current_ind") & (F.col(key) != guard))


def current_borrowers(dim_organization):
    return current_members(dim_organization, "organization_id", NO_ORGANIZATION)


def _looked_up(staged, dim_facility, ledger_raw, finish):
    """Staged transactions that met their facilities, as ``finish`` makes them."""
    sizes = None
    if ledger_raw is not None:
        sizes = sizes_of_heavy(
            ledger_raw.select(F.col("investment_ref").alias("facility_id")), ["facility_id"])
    known = current_members(dim_facility).select(
        "facility_id", packed(F.col("facility_sk"), surrogate_key(F.col("facility_id")))
        .alias("facility_sk"), F.col("fund_description").alias("servicing_fund"))
    # keys are worked out again from the ids: a hash is the part of a row that does not compress
    found = salted_lookup(
        staged.drop("transaction_sk"), known, ["facility_id"], ["transaction_id"], sizes)
    return finish(found)


def fact_source(staged, dim_facility, ledger_raw=None):
    """Staged transactions with facility key, servicing fund name and indicators.

    A transaction that cites an unknown facility is kept on the guard member. The raw rows,
    when given, tell which facilities are heavy without resolving transactions twice.
    """
    return _looked_up(staged, dim_facility, ledger_raw, lambda found: finish_fact(
        found.withColumns({
            "transaction_sk": surrogate_key(F.col("transaction_id")),
            "facility_sk": unpacked(F.col("facility_sk"), surrogate_key(F.col("facility_id"))),
        })))


def stored_source(staged, dim_facility, ledger_raw=None):
    """``fact_source`` as it is stored, see ``stored``."""
    guard = F.unhex(F.md5(F.lit(NO_FACILITY)))

    def finish(found):
        return _resolved(found.withColumn("transaction_sk", F.lit(LEFT_OUT))).withColumns({
            "facility_sk": F.coalesce("facility_sk", guard),
            "change_tracking_key": F.lit(LEFT_OUT)})

    return _looked_up(staged, dim_facility, ledger_raw, finish)


def _resolved(found):
    """Indicators of rows that carry ``facility_sk``, if they have one, and ``servicing_fund``."""
    return found.selectExpr(
        "transaction_sk", "transaction_id", "transaction_date",
        "coalesce(servicing_fund, fund_description) as fund_description", "share_class",
        "facility_sk", "facility_id", "transaction_type", "amount",
        "facility_sk is not null as known_facility_ind",
        f"coalesce(transaction_type = '{REMITTANCE}' and amount < 0, false) as adjustment_ind",
    )


def finish_fact(found):
    """Indicators and hash for rows that carry ``facility_sk`` and ``servicing_fund``."""
    resolved = _resolved(found).withColumn(
        "facility_sk", F.coalesce("facility_sk", F.md5(F.lit(NO_FACILITY))))
    return resolved.withColumn("change_tracking_key", row_hash(HASHED))


def resolve_orphans(fact, dim_facility):
    """Stored orphan transactions whose facility has become known, as upsert source."""
    known = current_members(dim_facility).select(
        "facility_id", "facility_sk", F.col("fund_description").alias("servicing_fund")
    )
    orphans = fact.filter(~F.col("known_facility_ind")).drop("facility_sk")
    return finish_fact(salted_lookup(orphans, known, ["facility_id"], ["transaction_id"],
                                     how="inner"))


def first_fact(source, run_ts):
    """The fact after its initial load: everything is an insert."""
    return source.withColumns({
        "record_inserted_ts": F.lit(run_ts).cast("timestamp_ntz"),
        "record_updated_ts": F.lit(None).cast("timestamp_ntz"),
    }).select(*FACT.fieldNames())


def _with_keys(df, spell):
    return df.withColumns({
        c: spell(F.col(c), surrogate_key(F.col(of))) for c, of in KEYS.items() if c in df.columns})


def stored(df):
    """Versions of transactions as they are stored: keys and hash that a row's other columns give,
    as a rule all of them, are left out, and the others packed. ``spelled_out`` gives them back."""
    hashed = df.withColumn("change_tracking_key", packed(
        F.col("change_tracking_key"), row_hash(HASHED)))
    return _with_keys(hashed, packed)


def spelled_keys(df):
    """Stored versions with their keys, and the hash as stored."""
    return _with_keys(df, unpacked)


def spelled_out(df):
    """The versions that ``stored`` made the table of."""
    return spelled_keys(df).withColumn("change_tracking_key", unpacked(
        F.col("change_tracking_key"), row_hash(HASHED)))


def comparable(df):
    """Stored versions with their hash, packed, and all else as stored."""
    spelled = spelled_keys(df.withColumns({f"_{c}": F.col(c) for c in KEYS if c in df.columns}))
    whole = spelled.withColumn("change_tracking_key", F.when(
        F.length("change_tracking_key") == 0, F.unhex(row_hash(HASHED))
    ).otherwise(F.col("change_tracking_key")))
    return whole.withColumns({c: F.col(f"_{c}") for c in KEYS if c in df.columns}).select(
        *df.columns)


def load_fact(fact, source, run_ts):
    """The fact after a load. Its source is written before it is read twice."""
    after = upsert(comparable(stored(fact)), comparable(written(stored(source), "delivery")),
                   "transaction_id", run_ts)
    return spelled_out(after)


class Marts:
    """The three mart tables of one state of the data, as stored."""

    def __init__(self, organization, facility, fact):
        self.organization = organization
        self.facility = facility
        self.fact = fact


class Exports(NamedTuple):
    """The raw tables of the three systems."""

    crm: DataFrame
    fac: DataFrame
    led: DataFrame


class BuiltMarts:
    """All marts from the raw exports, each defined when it is first asked for."""

    def __init__(self, exports, run_ts, aliases=None):
        self.exports, self.run_ts, self.aliases = exports, run_ts, aliases

    @cached_property
    def organization(self):
        borrowers = organizations(self.exports.crm, self.exports.fac)
        return load_organizations(None, borrowers, self.run_ts)

    @cached_property
    def stated(self):
        """Facilities with the balances the servicing system states."""
        return load_facilities(None, facilities(self.exports.fac), self.run_ts)

    @cached_property
    def staged(self):
        return resolve_transactions(parse_transactions(self.exports.led, self.aliases))

    @cached_property
    def facility(self):
        """Facilities with the balances the ledger shows."""
        return correct_balances(self.stated, net_funds_of_staged(self.staged))

    @cached_property
    def fact(self):
        return first_fact(
            fact_source(self.staged, self.stated, self.exports.led), self.run_ts
        )
