"""Byte-level BPE: merges replayed over the distinct words of many texts at once."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratelens.llm.common import id_field, map_texts, texts_of

# Words whose tokens a worker remembers, and bytes of new words that are
# replayed together. They bound memory, not results.
WORDS_KEPT = 400_000
REPLAY_BYTES = 1_000_000

NONE = -1  # before the first and after the last token of a word, and where a token was merged away


def read_ranks(path: str) -> bytes:
    """The rank file, base64 of the token and its rank on each line."""
    with open(path, "rb") as file:
        return file.read()


class MergeReplay:
    """Merges in rank order over all words of a batch.

    An inverted index leads from a merge to the positions at which its pair
    stands. The merge of the lowest rank is applied at all of them; only the
    pairs with the two neighbours of each merged position are looked up anew.
    """

    def __init__(self, ranks: bytes):
        lines = (line.split() for line in ranks.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.shift = max(self.tokens).bit_length()
        # Every way in which a token is two others: the pair's key leads to the token.
        self.pairs = {
            self.ranks[token[:cut]] << self.shift | self.ranks[token[cut:]]: rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        }
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array(
            [[self.pairs.get(int(a) << self.shift | int(b), NONE) for b in self.byte] for a in self.byte]
        )

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        split = [word for word in words if word not in self.ranks]
        replayed = iter(self._replay(split)) if split else iter(())
        return [next(replayed) if (whole := self.ranks.get(word)) is None else [whole] for word in words]

    def _replay(self, words: list[bytes]) -> list[list[int]]:
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(word) for word in words])
        outside = len(flat)  # the place of NONE
        after, before = np.arange(1, outside + 2), np.arange(-1, outside)
        after[ends - 1] = outside
        starts = np.append(0, ends[:-1])
        before[starts] = outside
        ranks = np.append(self.byte_pairs[flat[:-1], flat[1:]], NONE)
        ranks[ends - 1] = NONE
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        queue, first = np.unique(ranks[places], return_index=True)
        index = {
            rank: places[a:b].tolist()
            for rank, a, b in zip(queue.tolist(), first, np.append(first[1:], len(places)), strict=True)
        }
        queue = queue.tolist()  # sorted, so a heap
        symbols = [*self.byte[flat].tolist(), NONE]
        after, before, shift, merged = after.tolist(), before.tolist(), self.shift, self.pairs.get
        while queue:
            rank = heappop(queue)
            places = index.pop(rank, ())
            if len(places) > 1:
                places.sort()
            for done, at in enumerate(places, 1):
                right = after[at]
                if merged(symbols[at] << shift | symbols[right]) != rank:
                    continue  # one of the two was merged before; a key with NONE in it is negative
                symbols[at], symbols[right] = rank, NONE
                after[at] = following = after[right]
                before[following] = at
                lower = False
                left = before[at]
                for place, key in (
                    (left, symbols[left] << shift | rank),
                    (at, rank << shift | symbols[following]),
                ):
                    new = merged(key)
                    if new is not None:
                        if new in index:
                            index[new].append(place)
                        else:
                            index[new] = [place]
                            heappush(queue, new)
                        lower |= new < rank
                if lower and done < len(places):  # a merge of a lower rank goes first
                    index.setdefault(rank, []).extend(places[done:])
                    heappush(queue, rank)
                    break
        out = []
        for at in starts.tolist():
            ids = []
            while at != outside:
                ids.append(symbols[at])
                at = after[at]
            out.append(ids)
        return out


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit integers) and back."""

    def __init__(self, ranks: bytes, pattern: str):
        self.replay = MergeReplay(ranks)
        self.split = regex.compile(pattern).findall
        self.words: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        for word, ids in zip(new, self.replay.encode([word.encode() for word in new]), strict=True):
            self.words[word] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        split = [self.split(text) for text in texts]
        new, size = [], 0
        for word in set().union(*split).difference(self.words):
            new.append(word)
            size += len(word)
            if size >= REPLAY_BYTES:
                self._learn(new)
                new, size = [], 0
        self._learn(new)
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=1)
def encoder_of(ranks: bytes, pattern: str) -> Encoder:
    """Kept by a worker from task to task, with the words it has learnt."""
    return Encoder(ranks, pattern)


def bpe_encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode and decode every text; one row for each row of ``docs``.

    ``vocabulary`` is a rank file that the driver reads (its size is that of a
    vocabulary, not of the corpus). Each match of ``pattern`` is encoded alone;
    there are no special tokens. Columns: doc_id, n_tokens, ids_sha256 and
    decoded_sha256 (lowercase hex; of the packed ids and the decoded bytes),
    and with ``with_ids`` token_ids. A NULL text is an empty one: no tokens and
    the digests of nothing. Repeated rows give repeated results. No shuffle.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    fields = [
        id_field(docs, id_col),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))

    def start():
        encoder = encoder_of(ranks.value, pattern)

        def step(ids, texts):
            packed = encoder.encode([text or "" for text in texts])
            out = [
                ids,
                [len(p) // 4 for p in packed],
                [hashlib.sha256(p).hexdigest() for p in packed],
                [hashlib.sha256(encoder.decode(p)).hexdigest() for p in packed],
            ]
            return [*out, [np.frombuffer(p, "<i4") for p in packed]] if with_ids else out

        return step

    return map_texts(texts_of(docs, id_col, text_col), start, T.StructType(fields), "text")
