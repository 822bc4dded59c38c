"""SentencePiece ids of texts with the source bytes of every piece, and back.

A text is first normalised: at every place the longest prefix that the model's compiled
character map knows is replaced, else one character is taken as it is, and blanks become
``▁``. For every byte of the result the place in the source is recorded. Pieces are then
merged pair by pair, best score first and leftmost among equals; a character without a piece
falls back to its bytes. A piece covers what lies between the source places of its two ends,
so pieces cover every byte of the source once (of a character that became several pieces the
last one covers it).

No piece has ``▁`` behind another character and a line break is in no piece, so no merge
crosses either: each distinct stretch between them is merged once per task. Models for which
that does not hold are merged text by text. Models of other kinds than pair merges with byte
fallback are refused.

Defined cases: a null or empty text has no ids and decodes to an empty text; a null id comes
back as null; rows repeated whole are encoded alike; an empty table gives an empty result.
Extra columns are never looked at. Bytes that are not UTF-8 count as U+FFFD.
"""

import codecs
import heapq
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from .common import as_bytes, quoted
from .tokens import Places

MARK = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Distinct stretches kept at once, and stretches handled in one go.
TABLE, PORTION = 800_000, 100_000
#: Characters up to which the best pair is looked for in a list, and the rank of no piece.
SHORT, NONE = 40, 1 << 40
_coders = {}

codecs.register_error("bytewise", lambda e: ("�", e.start + 1))


def default_model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def fields(data):
    """(number, value) of every field of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class CharacterMap:
    """Replacements by longest prefix, from a double array of bytes and a pool of texts."""

    def __init__(self, compiled):
        size = struct.unpack_from("<I", compiled)[0]
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.pool = compiled[4 + size:]

    def longest(self, data, at):
        """Length of the longest known prefix of ``data`` from ``at``, and its replacement."""
        units, found = self.units, (0, None)
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        length, place = found
        return (length, self.pool[place:self.pool.index(b"\0", place)]) if length else (0, None)


class Model:
    """Pieces, scores and normaliser settings of a model file."""

    def __init__(self, path):
        with open(path, "rb") as file:
            data = file.read()
        self.texts, self.scores, self.kinds = [], [], []
        trainer, rules = {}, {}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                self.texts.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                rules = dict(fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) \
                or not {*self.kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} does not merge pairs with byte fallback")
        self.prefix, self.squeeze = rules.get(3, 1), rules.get(4, 1)
        self.blank = MARK if rules.get(5, 1) else " "
        self.map = CharacterMap(rules[2]) if rules.get(2) else None
        self.unknown = trainer.get(44, " ⁇ ".encode())
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}
        #: Place of every piece by score, the best first; equal for equal scores.
        places = {s: i for i, s in enumerate(sorted({self.scores[i] for i in self.ids.values()},
                                                    reverse=True))}
        self.ranks = {t: places[self.scores[i]] for t, i in self.ids.items()}
        self.bytes = {int(t[3:5], 16): i
                      for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        #: Bytes of the normalised text that each piece stands for.
        self.widths = np.array([1 if k == BYTE else len(t.encode())
                                for t, k in zip(self.texts, self.kinds)], np.int64)
        apart = not any(re.search(f"[^{MARK}]{MARK}|\n.|.\n", t, re.DOTALL) for t in self.ids)
        self.stretch = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if apart else r"(?s).+")

    def normalised(self, text):
        """The normalised text, and for each of its bytes and its end the place in the source."""
        source = text.encode()
        blank = self.blank.encode()
        if self.map is None and not self.squeeze:
            size = np.ones(len(source), np.int64)
            if len(blank) > 1:
                size[np.frombuffer(source, np.uint8) == 32] = len(blank)
            place = np.arange(len(source))
            inside = (np.frombuffer(source, np.uint8) & 0xC0) == 0x80
            place[inside] = 0
            starts = np.repeat(np.maximum.accumulate(place), size) if len(source) else place
            head = len(blank) if self.prefix and text else 0
            made = text.replace(" ", self.blank) if self.blank != " " else text
            return ((self.blank if head else "") + made,
                    np.concatenate([np.zeros(head, np.int64), starts, [len(source)]]))
        parts, starts, at = [], [], 0

        def step():
            length, made = self.map.longest(source, at) if self.map else (0, None)
            if not length:
                length = 1
                while at + length < len(source) and source[at + length] & 0xC0 == 0x80:
                    length += 1
                made = source[at:at + length]
            return length, made

        if self.squeeze:
            while at < len(source):
                length, made = step()
                if made != b" ":
                    break
                at += length
        if self.prefix and at < len(source):
            parts.append(blank)
            starts.append(np.full(len(blank), at))
        after_blank = bool(self.squeeze)
        while at < len(source):
            length, made = step()
            if after_blank:
                made = made.lstrip(b" ")
            if made:
                shown = made.replace(b" ", blank)
                parts.append(shown)
                starts.append(np.full(len(shown), at))
                after_blank = bool(self.squeeze) and made.endswith(b" ")
            at += length
        data = b"".join(parts)
        starts = np.concatenate([*starts, [len(source)]])
        if self.squeeze:
            while data.endswith(blank):
                data = data[:-len(blank)]
                starts = starts[:len(data) + 1]
        return data.decode(), starts

    def merged(self, stretch):
        """Ids of a normalised stretch."""
        ids, rank = self.ids, self.ranks.get
        parts = list(stretch)
        if len(parts) > SHORT:
            parts = self.merged_by_heap(parts)
        else:
            pairs = [rank(a + b, NONE) for a, b in zip(parts, parts[1:])]
            while pairs and (best := min(pairs)) != NONE:
                i = pairs.index(best)
                parts[i] += parts.pop(i + 1)
                del pairs[i]
                if i:
                    pairs[i - 1] = rank(parts[i - 1] + parts[i], NONE)
                if i < len(pairs):
                    pairs[i] = rank(parts[i] + parts[i + 1], NONE)
        made = []
        for part in parts:
            found = ids.get(part)
            if found is None:
                made += [self.bytes[b] for b in part.encode()]
            else:
                made.append(found)
        return made

    def merged_by_heap(self, parts):
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def offer(a, b):
            found = self.ranks.get(parts[a] + parts[b])
            if found is not None:
                heap.append((found, a, b, len(parts[a]) + len(parts[b])))
                return True

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        heapq.heapify(heap)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or len(parts[a]) + len(parts[b]) != size:
                continue  # one of the two has been merged since
            parts[a] += parts[b]
            parts[b] = None
            after[a] = after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if x >= 0 and y < len(parts) and offer(x, y):
                    heapq.heappush(heap, heap.pop())
        return [p for p in parts if p is not None]


class Coder:
    """Encodes and decodes texts; ids of distinct stretches are kept in a bounded table."""

    def __init__(self, path):
        self.model = model = Model(path)
        self.surfaces = [
            bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
            else model.unknown if k == UNKNOWN else t.replace(MARK, " ").encode()
            for t, k in zip(model.texts, model.kinds)]
        self.controls = {i for i, k in enumerate(model.kinds) if k == CONTROL}
        self.forget()

    def forget(self):
        self.places, self.start = Places(), np.zeros(1, np.int64)
        self.pool = np.empty(1 << 20, np.int32)

    def learn(self):
        new, self.places.new = self.places.new, []
        if not new:
            return
        ids = [self.model.merged(s) for s in new]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        used, more = int(self.start[-1]), int(length.sum())
        if used + more > len(self.pool):
            self.pool = np.concatenate([self.pool[:used], np.empty(used + 2 * more, np.int32)])
        self.pool[used:used + more] = np.fromiter(chain.from_iterable(ids), np.int32, more)
        self.start = np.concatenate([self.start, used + np.cumsum(length)])

    def encode_all(self, texts):
        """Yield lists of (ids, ends): the ids of some texts and the source place where every
        piece ends."""
        waiting, starts, count = [], [], 0
        for text in texts:
            made, source = self.model.normalised(text)
            parts = self.model.stretch.findall(made)
            waiting.append(np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts)))
            starts.append(source)
            count += len(parts) + len(made) // 8
            if count > PORTION:
                yield self.finish(waiting, starts)
                waiting, starts, count = [], [], 0
                if len(self.places) > TABLE:
                    self.forget()
        if waiting:
            yield self.finish(waiting, starts)

    def finish(self, waiting, starts):
        self.learn()
        made = []
        for places, source in zip(waiting, starts):
            first = self.start[places]
            length = self.start[places + 1] - first
            ends = np.concatenate([[0], np.cumsum(length)])
            ids = self.pool[np.repeat(first - ends[:-1], length) + np.arange(ends[-1])]
            made.append((ids, source[np.cumsum(self.model.widths[ids])]))
        return made

    def decode(self, ids):
        """The text of a list of ids."""
        model = self.model
        head = 0
        if model.prefix or model.squeeze:
            first = next((i for i in ids if model.kinds[i] != CONTROL), None)
            if first is not None and model.kinds[first] == NORMAL \
                    and model.texts[first].startswith(MARK):
                head = 1
        # a control piece has no text, but bytes before and behind it make no character
        runs, run = [], []
        for i in ids if self.controls.intersection(ids) else ():
            if i in self.controls:
                runs.append(run)
                run = []
            else:
                run.append(i)
        runs.append(run if runs else ids)
        data = [b"".join(map(self.surfaces.__getitem__, r)) for r in runs]
        made = "".join(d.decode("utf-8", "bytewise") for d in data)
        return made[head:]


def coder(path):
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encoded(docs, id_col="doc_id", text="text", model=None):
    """doc_id, ids, ends (the source byte where every piece ends; it begins where the one before
    ends, the first at 0) and decoded, the text that the ids give, of every row."""
    path = model or default_model()
    given = docs.select(quoted(id_col).alias("doc_id"), quoted(text).cast("string").alias("text"))
    schema = T.StructType([given.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("ends", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])

    def lists(arrays):
        stops = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(stops), pa.array(np.concatenate(arrays).astype(np.int32)))

    def run(batches):
        own = coder(path)
        for batch in batches:
            at = 0
            texts = ((t or b"").decode("utf-8", "replace") for t in as_bytes(batch.column(1)))
            for made in own.encode_all(texts):
                ids, ends = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(made)), lists(ids), lists(ends),
                     pa.array([own.decode(i.tolist()) for i in ids], pa.string())],
                    names=schema.names)
                at += len(made)

    return given.mapInArrow(run, schema)


def decoded(rows, ids="ids", model=None, name="decoded"):
    """``rows`` with the text of their column of ids (array of int; null: null)."""
    path = model or default_model()

    @F.pandas_udf("string")
    def texts(column):
        own = coder(path)
        return column.map(lambda x: None if x is None else own.decode(x.tolist()))

    return rows.withColumn(name, texts(quoted(ids)))


def pieces(docs, id_col="doc_id", text="text", model=None):
    """One row per piece: doc_id, place, id, begin and end (bytes of the source)."""
    made = encoded(docs, id_col, text, model)
    begin = F.when(F.col("place") == 0, 0).otherwise(F.get("ends", F.col("place") - 1))
    return made.select("doc_id", "ends", F.posexplode("ids").alias("place", "id")).select(
        "doc_id", "place", "id", begin.alias("begin"), F.get("ends", "place").alias("end"))


def round_trip(docs, id_col="doc_id", text="text", model=None):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, and covered: the bytes that the pieces
    cover, which is all of the text."""
    made = encoded(docs, id_col, text, model)
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("covered"))
