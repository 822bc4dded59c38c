"""Ids, spans and texts against the sentencepiece library."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from cases import DOCS, awkward, document

from tallystone.llm import sentencepieces
from tallystone.llm.common import table

SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", "  a  b  ", "a\tb", "x\n\n y\n", "\n", "\n \n", "日本語 テキスト",
       "½ ² ﬁ Å é", "▁a ▁▁ b▁", "<s> a</s> <0x0A> <unk>", "\x00a\x00", "　x", "🙂🙂 🙂", "​",
       "é ́", "�", "\U000e0041", "aaaa" * 500, " " * 100 + "x", "a▁" * 60, "́", "\r\n x",
       "Ünï-códe " * 30, "0123456789" * 20, "https://a.b/c?d=e&f=%20" * 9]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())


def random_texts(n, seed=5):
    rng = random.Random(seed)
    letters = "aaeeinost  \n▁.,é日½🙂\t́<>01"
    return ["".join(rng.choices(letters, k=rng.randint(0, 90))) for _ in range(n)]


@pytest.mark.parametrize("short,limit", [(40, 400_000), (0, 50)])
def test_ids_spans_and_texts_equal_the_library(monkeypatch, spark, library, short, limit):
    monkeypatch.setattr(sentencepieces, "SHORT", short)
    monkeypatch.setattr(sentencepieces, "TABLE", limit)
    monkeypatch.setattr(sentencepieces, "PORTION", 2000)
    texts = ODD + random_texts(1500)
    texts += [r["text"] or "" for r in table(spark, SMALL, "documents").collect()]
    own = sentencepieces.Coder(sentencepieces.default_model())
    made = [x for part in own.encode_all(texts) for x in part]
    for text, (ids, ends) in zip(texts, made, strict=True):
        whole = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in whole]
        assert [0, *ends.tolist()][:-1] == [p.begin for p in whole]
        assert ends.tolist() == [p.end for p in whole]
        assert own.decode(ids.tolist()) == library.decode(ids.tolist())


def test_any_ids_decode_as_in_the_library(library):
    rng = random.Random(3)
    own = sentencepieces.Coder(sentencepieces.default_model())
    size = library.get_piece_size()
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(size), 28705, 259])
               for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc", "identity"])
def test_compiled_maps_as_in_the_library(rule):
    """Longest prefixes and source places under the compiled maps that the library holds."""
    whole = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    rules = dict(sentencepieces.fields(whole.serialized_normalizer_spec()))
    model = object.__new__(sentencepieces.Model)
    model.map = sentencepieces.CharacterMap(rules[2]) if rules.get(2) else None
    model.prefix, model.squeeze = rules.get(3, 1), rules.get(4, 1)
    model.blank = "▁" if rules.get(5, 1) else " "
    for text in ODD + random_texts(400) + ["ｱﾞ ㌔ ① ﬃ ㍿", "　ａ　　ｂ　", "Ǻ ẛ̣ ß İ"]:
        made, starts = model.normalised(text)
        wanted, places = whole.normalize(text, with_offsets=True)
        assert made == wanted
        source = text.encode()
        at, own = 0, []
        for c in made:  # the library counts characters
            own.append(len(source[:starts[at]].decode()))
            at += len(c.encode())
        assert [*own, len(source[:starts[at]].decode())] == places or not made


def test_whole_table(spark, library):
    docs = table(spark, SMALL, "documents").unionByName(
        awkward(spark).select("doc_id", "text", "lang", "source", "n_chars"))

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    wanted = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "")
        wanted[r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)),
               len((r["text"] or "").encode())] += 1
    assert Counter(map(tuple, sentencepieces.round_trip(docs).collect())) == wanted
    assert sentencepieces.round_trip(spark.createDataFrame([], DOCS)).collect() == []


def test_pieces_and_back(spark):
    docs = spark.createDataFrame([document(1, "Hé 日 \n x"), document(2, None)], DOCS)
    rows = sentencepieces.pieces(docs).orderBy("doc_id", "place").collect()
    source = "Hé 日 \n x".encode()
    assert b"".join(source[r["begin"]:r["end"]] for r in rows) == source
    assert {r["doc_id"] for r in rows} == {1}
    again = sentencepieces.decoded(sentencepieces.encoded(docs).drop("decoded")).collect()
    assert {(r["doc_id"], r["decoded"]) for r in again} == {(1, "Hé 日 \n x"), (2, "")}
