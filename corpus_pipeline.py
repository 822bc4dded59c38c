"""From raw documents to packed training sequences.

Every stage takes what its predecessor kept, as written by it.
"""

from tallystone.llm import host_rules, lines, mixing, packing, simhash
from tallystone.llm.common import materialize, table

STAGES = [
    ("quality rules", lambda spark, docs, sf_dir: host_rules.quality_documents(docs)),
    ("line dedup", lambda spark, docs, sf_dir: lines.without_common_lines(docs, keep_first=True)),
    ("near-duplicate documents", lambda spark, docs, sf_dir: simhash.one_of_each(docs)),
    ("mixing", lambda spark, docs, sf_dir: mixing.mixed_documents(docs)),
    ("packing", lambda spark, docs, sf_dir: packing.packed_pieces(docs)),
]

#: Fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
