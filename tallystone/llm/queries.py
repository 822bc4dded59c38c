"""One query per operator, over its whole table, with production parameters."""

from .common import table
from . import (
    host_rules, langid, lines, merkle, mixing, ngrams, packing, prefixes, sentencepieces, simhash,
    toxicity, vectors, warc,
)


def documents(spark, folder):
    return table(spark, folder, "documents")


QUERIES = {
    "op1_warc": lambda spark, d: warc.archived(table(spark, d, "pages")),
    "op2_ngram_scores": lambda spark, d: ngrams.text_scores(documents(spark, d)),
    "op3_toxicity": lambda spark, d: toxicity.toxicity(
        documents(spark, d), table(spark, d, "labels")),
    "op4_packing": lambda spark, d: packing.packed_pieces(documents(spark, d)),
    "op5_vectors": lambda spark, d: vectors.near_duplicates(table(spark, d, "embeddings")),
    "op6_host_rules": lambda spark, d: host_rules.quality_verdicts(documents(spark, d)),
    "op7_simhash": lambda spark, d: simhash.near_duplicates(documents(spark, d)),
    "op8_line_dedup": lambda spark, d: lines.line_report(documents(spark, d)),
    "op9_mixing": lambda spark, d: mixing.mixed_sizes(documents(spark, d)),
    "op10_language": lambda spark, d: langid.languages(documents(spark, d)),
    "op11_prefix_trie": lambda spark, d: prefixes.spliced_trie(table(spark, d, "conversations")),
    "op12_merkle": lambda spark, d: merkle.tamper_report(documents(spark, d)),
    "op13_sentencepieces": lambda spark, d: sentencepieces.round_trip(documents(spark, d)),
}

ORACLES = {
    "op1_warc": warc.ORACLE,
    "op6_host_rules": host_rules.ORACLE,
    "op8_line_dedup": lines.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_prefix_trie": prefixes.ORACLE,
    "op12_merkle": merkle.ORACLE,
}
