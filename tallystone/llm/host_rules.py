"""Quality rules with a verdict per host.

Each document is measured once. The share of a host's documents that fail a rule is shrunk
towards all hosts with a beta prior, whose two parameters come from the mean and variance of
the rates over hosts (moments, each host counted by its documents). A host whose shrunk rate
of any rule exceeds ``limit`` is rejected, and with it all its documents; so are the
documents that fail the base rules themselves.

Defined cases: a null text has no words; a null host is a host of its own; rows repeated
whole are measured separately; an empty table gives an empty result.
"""

import numpy as np
from pyspark.sql import functions as F, types as T

from .common import SPACE, few, map_texts, materialize, quoted

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Rules by name; the first two are the base rules.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines > 10 and 5 * n_dup_lines > n_words",
}


def repeated_words(words):
    """How many words stand in a three-word window that occurs twice or more in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) < 1 << 21:
        key = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
    else:
        pair = np.unique((a[:-1] << 31) | a[1:], return_inverse=True)[1]
        key = (pair[:-1] << 31) | a[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift:shift + n] |= twice
    return int(inside.sum())


def measure(text):
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    points = len(text.decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        points - (len(text) - len(text.translate(None, SPACE))),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measured(docs, keep, text="text"):
    """``keep`` by position (c0, c1, ...) and the measures of every row's text."""
    fields = [T.StructField(n, T.LongType(), False) for n in MEASURES]

    def start():
        return lambda texts: list(zip(*map(measure, texts))) or [[]] * len(MEASURES)

    return map_texts(docs, text, keep, fields, start)[0].withColumn(
        "base_failed", F.expr(f"({RULES['short']}) or ({RULES['repetitive']})"))


def host_rates(rows, host):
    """Per host: documents, and for each rule the failures and the shrunk rate."""
    hosts = rows.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("docs"),
        *[F.count_if(F.expr(rule)).alias(f"{name}_failed") for name, rule in RULES.items()])
    return materialize(hosts, "host-counts")


def beta_prior(hosts, rule):
    """alpha and beta of the rule's rate over hosts, by moments, as a one-row aggregate."""
    rate = F.col(f"{rule}_failed") / F.col("docs")
    all_docs = F.sum("docs")
    mean = F.sum(f"{rule}_failed") / all_docs
    spread = F.sum(F.col("docs") * rate * rate) / all_docs - mean * mean
    # sampling noise of a rate is part of its spread over hosts
    noise = mean * (1 - mean) * F.count(F.lit(1)) / all_docs
    return mean.alias(f"{rule}_mean"), F.greatest(spread - noise, F.lit(0.0)).alias(
        f"{rule}_spread")


def host_verdicts(rows, host, limit):
    """Rejected hosts with their rates. ``rows`` has the measures."""
    hosts = host_rates(rows, host)
    row = hosts.agg(*[c for rule in RULES for c in beta_prior(hosts, rule)]).first()
    rates = []
    for rule in RULES:
        mean, spread = row[f"{rule}_mean"] or 0.0, row[f"{rule}_spread"] or 0.0
        # hosts that hardly differ: a prior as strong as a thousand documents
        strength = min(1000.0, mean * (1 - mean) / spread - 1) if spread > 0 else 1000.0
        strength = max(strength, 1.0)
        rates.append(((F.col(f"{rule}_failed") + mean * strength)
                      / (F.col("docs") + strength)).alias(f"{rule}_rate"))
    shrunk = hosts.select("host", "docs", *rates)
    worst = F.greatest(*[F.col(f"{rule}_rate") for rule in RULES])
    return shrunk.filter(worst > limit)


def judged(rows, measures, host, limit):
    """``rows`` with ``kept``; ``measures`` is a written table of all measures by ``host``.

    Rejected hosts are sent to all tasks if they are few; otherwise both sides shuffle, and
    Spark splits a hot host's partition.
    """
    bad = few(materialize(host_verdicts(measures, "c0", limit).select(
        F.col("host").alias("bad_host"), F.lit(True).alias("host_rejected")), "bad-hosts"))
    return rows.join(bad, F.col(host).eqNullSafe(F.col("bad_host")), "left").withColumn(
        "kept", ~F.col("base_failed") & F.col("host_rejected").isNull()
    ).drop("bad_host", "host_rejected")


def quality_verdicts(docs, id_col="doc_id", text="text", host="source", limit=0.6):
    """doc_id, the measures, base_failed and kept of every document."""
    rows = materialize(measured(docs, [host, id_col], text), "host-measures")
    return judged(rows, rows, "c0", limit).select(
        F.col("c1").alias("doc_id"), *MEASURES, "base_failed", "kept")


def quality_documents(docs, text="text", host="source", limit=0.6):
    """The rows of ``docs`` that are kept, with their own columns.

    Texts are measured once for the hosts and once more on their way through, as that is
    cheaper than to write or shuffle them.
    """
    measures = materialize(measured(docs, [host], text), "host-measures")
    rows = measured(docs, docs.columns, text)
    kept = judged(rows, measures, f"c{docs.columns.index(host)}", limit).filter("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


ORACLE = r"""
WITH tokens AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM tokens),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM windows),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + shift) AS n_repeat_words
  FROM twice, (SELECT unnest([0, 1, 2]) AS shift) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM tokens),
dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measures AS (
  SELECT t.doc_id, source, len(words)::bigint AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
         coalesce(n_dup_lines, 0)::bigint AS n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
  FROM tokens t LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id)),
flags AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures),
hosts AS (
  SELECT source, count(*) AS docs,
         unnest([count(*) FILTER (n_words < 50),
                 count(*) FILTER (100 * n_repeat_words > 50 * n_words),
                 count(*) FILTER (10 * n_symbols > n_words),
                 count(*) FILTER (n_dup_lines > 10 AND 5 * n_dup_lines > n_words)]) AS failed,
         unnest([1, 2, 3, 4]) AS rule
  FROM flags GROUP BY source),
moments AS (
  SELECT rule, sum(failed) / sum(docs) AS mean,
         greatest(sum(docs * (failed / docs) * (failed / docs)) / sum(docs)
           - (sum(failed) / sum(docs)) * (sum(failed) / sum(docs))
           - (sum(failed) / sum(docs)) * (1 - sum(failed) / sum(docs)) * count(*) / sum(docs), 0)
           AS spread
  FROM hosts GROUP BY rule),
priors AS (
  SELECT rule, mean, greatest(1, CASE WHEN spread > 0
    THEN least(1000, mean * (1 - mean) / spread - 1) ELSE 1000 END) AS strength
  FROM moments),
bad AS (
  SELECT source FROM hosts JOIN priors USING (rule)
  GROUP BY source HAVING max((failed + mean * strength) / (docs + strength)) > 0.6)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (
         SELECT 1 FROM bad b WHERE b.source IS NOT DISTINCT FROM f.source) AS kept
FROM flags f
"""
