"""Token ids of texts, with each distinct stretch between blanks tokenized once.

Byte-level BPE first splits a text into words and never merges across them. A single blank
between two other characters always starts a word, whatever stands around it, so the
stretches between such blanks can be tokenized one by one and their ids strung together.
"""

import base64
import re
from itertools import chain

import numpy as np

#: Added tokens of byte_bpe_50k.json; its tiktoken form holds the ranks only.
ADDED = {"<|endoftext|>": 50256}
BLANK = re.compile(r"(?<!\s) (?=\S)")
RUN = re.compile(r"\s\s")
#: Distinct stretches kept at once, and stretches handled in one go.
TABLE, PORTION = 400_000, 200_000


def byte_pair_encoder(path):
    """A function from texts to lists of ids; an added token's name in a text is that token."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                mergeable_ranks=ranks, special_tokens=ADDED)
        return lambda texts: [own.encode(t, allowed_special="all") for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [x.ids for x in tokenizer.encode_batch_fast(
        texts, add_special_tokens=False)]


class Places(dict):
    """Stretch to place; a new one gets the next place and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, stretch):
        self[stretch] = place = len(self)
        self.new.append(stretch)
        return place


class Encoder:
    """Ids of texts by the byte-level BPE file at ``path``, for tokenizers or tiktoken."""

    def __init__(self, path):
        self.encode = byte_pair_encoder(path)
        self.forget()

    def forget(self):
        self.places = Places()
        self.pool = np.empty(1 << 20, np.uint32)
        self.start = np.zeros(1, np.int64)

    def learn(self):
        """Tokenize the stretches that are new."""
        new, self.places.new = self.places.new, []
        if not new:
            return
        # the first stretch of a text is marked by a blank, the others are preceded by one
        ids = self.encode([s[1:] if s[:1] == " " else f" {s}" for s in new])
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum()))
        used = int(self.start[-1])
        if used + len(flat) > len(self.pool):
            more = np.empty(2 * (used + len(flat)), np.uint32)
            more[:used] = self.pool[:used]
            self.pool = more
        self.pool[used:used + len(flat)] = flat
        self.start = np.concatenate([self.start, used + np.cumsum(length)])

    def encode_all(self, texts):
        """Yield the ids of each text (str or None)."""
        waiting, count = [], 0
        for text in texts:
            parts = BLANK.split(text) if RUN.search(text or "") else (text or "").split(" ")
            parts[0] = f" {parts[0]}"
            waiting.append(np.fromiter(map(self.places.__getitem__, parts), np.int64, len(parts)))
            count += len(parts)
            if count > PORTION:
                yield from self.finish(waiting)
                waiting, count = [], 0
                if len(self.places) > TABLE:
                    self.forget()
        if waiting:
            yield from self.finish(waiting)

    def finish(self, waiting):
        self.learn()
        places = np.concatenate(waiting)
        first = self.start[places]
        length = self.start[places + 1] - first
        ends = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.repeat(first - ends[:-1], length) + np.arange(ends[-1])]
        at = 0
        for x in waiting:
            yield ids[ends[at]:ends[at + len(x)]]
            at += len(x)
