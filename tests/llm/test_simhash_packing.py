import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from cases import DOCS, awkward, document, lower, plain, words

import corpus_pipeline
from tallystone.llm import host_rules, lines, mixing, packing, simhash, tokens
from tallystone.llm.common import materialize, table
from tallystone.llm.components import connected

SMALL = "/root/testdata/sf0.001"


def by_hand(text):
    own = [lower(w) for w in words(text)]
    grams = [b" ".join(own[i:i + 3]) for i in range(len(own) - 2)] or ([b" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 3 and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


def components_by_hand(rows):
    label = groups_by_hand({p for _, p in rows})
    least = defaultdict(list)
    for i, p in rows:
        least[label[p]].append(i)
    return [min((i for i in least[label[p]] if i is not None), default=None) for _, p in rows]


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_near_copies_by_hand(spark, which):
    docs = table(spark, SMALL, "documents") if which == "small" else awkward(spark)
    given = [(r["doc_id"], by_hand(r["text"])) for r in docs.collect()]
    wanted = Counter((i, f"{p:016x}", c) for (i, p), c in zip(given, components_by_hand(given)))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == wanted


def test_long_text_in_chunks(monkeypatch):
    text = plain(2000).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole == by_hand(plain(2000))


@pytest.mark.parametrize("budget,block,count", [(3, 1000, 1), (3, 5, 1), (3, 4, 1 << 24),
                                                (2, 6, 1 << 40)])
def test_tries_find_every_link(spark, monkeypatch, budget, block, count):
    """Dense groups cut into blocks, and the tables that larger corpora would use."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = set(base.tolist())
    for p in base[:12].tolist():
        for _ in range(14):
            q = p
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                q ^= 1 << int(b)
            prints.add(q)
    prints = sorted(prints)
    if count > 1:
        tables = simhash.bit_tables(count, budget)
        monkeypatch.setattr(simhash, "bit_tables", lambda n, b: tables)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = connected(simhash.links(rows, budget, block)).collect()
    label = {p: p for p in prints}
    for r in found:
        label[r["node"] % (1 << 64)] = r["component"] % (1 << 64)
    groups = defaultdict(set)
    for p, g in label.items():
        groups[g].add(p)
    wanted = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= budget and wanted[a] is not wanted[b]:
                wanted[a] |= wanted[b]
                for x in wanted[b]:
                    wanted[x] = wanted[a]
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in wanted.values()}


def test_components_of_a_chain(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    apart = spark.createDataFrame([(1000, 1001), (1001, 1001)], "a long, b long")
    found = connected(chain.unionByName(apart)).collect()
    sizes = Counter(r["component"] for r in found)
    assert sorted(sizes.values()) == [2, 301] and len({r["node"] for r in found}) == 303


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = simhash.one_of_each(docs)
    assert kept.schema.names == docs.schema.names
    given = [(r["doc_id"], by_hand(r["text"])) for r in docs.collect()]
    label = groups_by_hand({p for _, p in given})
    mine = kept.collect()
    assert len(mine) == len(set(label.values()))
    assert Counter(r["doc_id"] for r in mine) == Counter(
        components_by_hand([(i, p) for i, p in given])[given.index((i, p))]
        for i, p in {label[p]: (i, p) for i, p in given}.values())


def test_one_copy_of_a_clean_text_keeps_its_lines(spark):
    """Stages 2 and 3: no group is emptied, and groups are not linked through empty texts."""
    groups = ["\n".join(plain(40, f"{name}{k}x") for k in range(4)) for name in "abc"]
    rows = [document(100 * g + i, t) for g, t in enumerate(groups) for i in range(20)]
    rows += [document(1000 + i, plain(60, f"own{i}x")) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = materialize(stage(spark, docs, SMALL), "stage")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert Counter(t for t in kept.values() if t) == Counter(
        groups + [plain(60, f"own{i}x") for i in range(5)])
    assert all(kept[100 * g] == t for g, t in enumerate(groups))


@pytest.mark.parametrize("held", [lines.HELD, 0])
def test_of_equal_rows_the_first_keeps_its_lines(spark, monkeypatch, held):
    monkeypatch.setattr(lines, "HELD", held)
    common = plain(30, "common")
    rows = [document(i, f"{common}\nown {k}\n{common}") for i, k in [(5, 0)] * 12 + [(9, 9)]]
    rows += [document(7, "clean"), document(8, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    kept = Counter(r["text"] for r in lines.without_common_lines(docs, keep_first=True).collect())
    assert kept == {f"{common}": 1, "": 11, "own 9": 1, "clean": 1, None: 1} or kept == {
        f"{common}\nown 0": 1, "": 11, "own 9": 1, "clean": 1, None: 1}
    made = Counter(r["n_dropped"] for r in lines.line_report(docs).collect())
    assert made == {3: 12, 2: 1, 0: 2}


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = ["", None, " ", "a", " a", "a ", "a  b", "x\n  b", "x \n", "\n\n a", "I'll we've  it's 's",
       "日本語 テキスト", "½ ² x", "a  b", "a  b", "\x1c \x1d x", "tab\tb \t c", "é x"]


@pytest.mark.parametrize("kind", ["json", "tiktoken"])
def test_ids_equal_the_tokenizers(spark, monkeypatch, kind):
    import public_tokenizers

    monkeypatch.setattr(tokens, "TABLE", 500)
    monkeypatch.setattr(tokens, "PORTION", 300)
    texts = ODD + [r["text"] for r in table(spark, SMALL, "documents").collect()]
    made = tokens.Encoder(public_tokenizers.path(f"byte_bpe_50k.{kind}")).encode_all(texts)
    whole = tokenizer()
    for text, ids in zip(texts, made, strict=True):
        assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids


NAMED = ["<|endoftext|>", "end of page <|endoftext|> next", "glued<|endoftext|>word",
         "<|endoftext|> first", " <|endoftext|>", "last <|endoftext|>", "blank after <|endoftext|> ",
         "a  <|endoftext|>  b", "x\n<|endoftext|>\n\ny", "<|endoftext|><|endoftext|> <|endoftext|>",
         "I<|endoftext|>'ll", "<|endoftext|", "<| endoftext |>", "<|ENDOFTEXT|>"]


@pytest.mark.parametrize("kind", ["json", "tiktoken"])
def test_added_token_named_in_a_text(kind):
    import public_tokenizers

    made = tokens.Encoder(public_tokenizers.path(f"byte_bpe_50k.{kind}")).encode_all(NAMED)
    whole = tokenizer()
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in NAMED]
    assert wanted[1] == [437, 286, 2443, 220, 50256, 1306]
    assert [ids.tolist() for ids in made] == wanted


def test_packing_of_a_named_token(spark):
    texts = dict(enumerate(NAMED))
    docs = spark.createDataFrame([document(i, t) for i, t in texts.items()], DOCS)
    check_places(packing.packed_pieces(docs).collect(), {i: [t] for i, t in texts.items()})


def check_places(rows, texts, capacity=1024):
    """Every document is there in order, and sequences are filled without gaps or overlaps."""
    whole = tokenizer()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    for doc_id, copies in texts.items():
        ids = np.array([*whole.encode(copies[0] or "", add_special_tokens=False).ids, 2], "<u4")
        wanted = []
        first = len(ids) % capacity or capacity
        for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[start:first if not start else start + capacity]
            wanted.append((piece, start, len(part), zlib.crc32(part.tobytes())))
        assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"])
                       for r in pieces[doc_id]) == Counter(wanted * len(copies))
    return len(sequences), sum(r["length"] for r in rows)


def test_packing(spark):
    docs = table(spark, SMALL, "documents")
    rows = packing.packed_pieces(docs).collect()
    used, total = check_places(rows, {r["doc_id"]: [r["text"]] for r in docs.collect()})
    assert used <= 1.02 * -(-total // 1024) + 1


def test_packing_awkward_documents(spark):
    docs = awkward(spark).filter("doc_id is not null")
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    check_places(packing.packed_pieces(docs).collect(), texts)
    assert packing.packed_pieces(awkward(spark)).filter("doc_id is null").count() == 3
    assert packing.packed_pieces(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(3).integers(1, 700, 500)
    bins = packing.best_fit(lengths, 1024, 3, 500_000, np.ones(3), rule)
    for b in range(bins.max() + 1):
        own = lengths[bins == b].astype(float)
        assert 1 <= len(own) <= 3 and own.sum() <= 1024
        assert (own ** 2).sum() <= 500_000


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([document(i, plain(9 * i)) for i in range(60)], DOCS)
    made = packing.packed_sequences(docs, shard=20).collect()
    whole = tokenizer()
    ids = sorted(t for i in range(60) for t in [*whole.encode(plain(9 * i)).ids, 2])
    assert sorted(t for r in made for t in r["ids"]) == ids
    pieces = defaultdict(list)  # of each document, as ids
    for i in range(60):
        own = [*whole.encode(plain(9 * i)).ids, 2]
        pieces[i] = [own[a:a + n] for a, n in zip(*packing.cut(len(own), 1024))]
    for r in made:
        at = 0
        for i in r["doc_ids"]:
            piece = next(p for p in pieces[i] if r["ids"][at:at + len(p)] == p)
            pieces[i].remove(piece)
            at += len(piece)
        assert at == len(r["ids"]) <= 1024
    assert not any(pieces.values())


@pytest.mark.parametrize("which", ["small", "awkward"])
def test_pipeline_by_hand(spark, tmp_path, which):
    docs = table(spark, SMALL, "documents") if which == "small" else awkward(spark)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    given = [r.asDict() for r in docs.collect()]
    good = [r for r in given if not (len(words(r["text"])) < 50 or 100 * host_rules.repeated_words(
        words(r["text"])) > 50 * len(words(r["text"])))]
    keys = [[lower(x.strip(b" \t\n\x0b\x0c\r")) for x in r["text"].encode().split(b"\n")]
            for r in good]
    seen = Counter(k for own in keys for k in set(own) if k)
    met = set()  # the first line of a common key stays, in the document of smallest id
    for r, own in sorted(zip(good, keys), key=lambda x: (x[0]["doc_id"] is None, x[0]["doc_id"] or 0)):
        stay = []
        for x, k in zip(r["text"].encode().split(b"\n"), own):
            if seen[k] < 10 or not k or k not in met:
                stay.append(x)
            met.add(k)
        r["text"] = b"\n".join(stay).decode()
    prints = [(r["doc_id"], by_hand(r["text"])) for r in good]
    label = groups_by_hand({p for _, p in prints})
    first = {}
    for r, (i, p) in zip(good, prints):
        at = first.get(label[p])
        if at is None or (i is not None and (at["doc_id"] is None or i < at["doc_id"])):
            first[label[p]] = r
    single = spark.createDataFrame([tuple(r.values()) for r in first.values()], docs.schema)
    taken = defaultdict(list)
    for r in mixing.mixed_documents(materialize(single, "by-hand")).collect():
        taken[r["doc_id"]].append(r["text"])
    check_places(rows, taken)
    assert {r["doc_id"] for r in rows} == set(taken)


def test_stages_return_documents(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][1:3] == ["line dedup",
                                                                 "near-duplicate documents"]
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, None), "stage")
        assert docs.schema.names == DOCS.names
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), None).collect() == []
