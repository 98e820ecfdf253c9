"""Byte-pair encoding and decoding with a given vocabulary.

A text is cut into words by the vocabulary's pattern. The symbols of a word form a doubly
linked list, and the merges that its neighbours allow lie in a priority queue by rank and
place. The best one joins two symbols and brings up to two new neighbours; an entry whose
symbols have changed meanwhile is stale and is skipped. Decoding concatenates the vocabulary
strings of the ids and maps their characters back to bytes.

Texts are whole and stay where they are: each row is encoded in its task, in batches, without
a shuffle. A task keeps the ids of the words it has met, up to a fixed number of words.

Defined cases: null text is empty text, which has no ids. A special token that stands in the
text gives its own id. Equal texts give equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_KEPT = 300_000  # words of each of the two sets that a worker remembers
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in vocabulary strings: itself if it can be
    printed, else the next unused one from 256 on."""
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    told = {b: chr(b) for b in printed}
    for b in range(256):
        told.setdefault(b, chr(256 + len(told) - len(printed)))
    return told


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        of_byte = byte_characters()
        self.first = [vocab[of_byte[b]] for b in range(256)]
        self.merge: dict[int, tuple[int, int]] = {}  # pair of ids -> (rank, id)
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.merge[vocab[left] << 32 | vocab[right]] = (rank, vocab[left + right])
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.to_byte = {c: b for b, c in of_byte.items()}
        self.pattern = regex.compile(WORD_PATTERN)
        self.apart = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Words met lately, and those met before them: a full set replaces the older one, so that
        # frequent words stay and memory is bounded.
        self.words: dict[str, tuple[int, bytes, bytes]] = {}
        self.older: dict[str, tuple[int, bytes, bytes]] = {}

    def encode_word(self, word: str) -> list[int]:
        ids = [self.first[b] for b in word.encode("utf-8")]
        n = len(ids)
        if n == 1:
            return ids
        merge = self.merge
        queue = []
        for i in range(n - 1):
            found = merge.get(ids[i] << 32 | ids[i + 1])
            if found:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        if not queue:
            return ids
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = made, -1
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
                found = merge.get(made << 32 | ids[k])
                if found:
                    heapq.heappush(queue, (found[0], i, made, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merge.get(ids[h] << 32 | made)
                if found:
                    heapq.heappush(queue, (found[0], h, ids[h], made, found[1]))
        return [x for x in ids if x >= 0]

    def decode_bytes(self, ids: list[int]) -> bytes:
        joined = "".join([self.strings[i] for i in ids])
        return bytes([self.to_byte[c] for c in joined])

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings put together; special tokens as they are written."""
        named = {i: s.encode() for s, i in self.special.items()}
        parts = [named[i] if i in named else self.decode_bytes([i]) for i in ids]
        return b"".join(parts).decode("utf-8", "replace")

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special tokens (False) and the special tokens in it (True)."""
        at = 0
        for m in self.apart.finditer(text) if self.apart else ():
            if m.start() > at:
                yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def encode(self, text: str) -> list[int]:
        told: list[int] = []
        for part, is_special in self.segments(text):
            if is_special:
                told.append(self.special[part])
            else:
                for word in self.pattern.findall(part):
                    told += self.encode_word(word)
        return told

    def known(self, word: str) -> tuple[int, bytes, bytes]:
        """Number of ids of a word, the ids in decimals with a comma before each, and the decoded bytes."""
        found = self.words.get(word)
        if found is None:
            found = self.older.get(word)
            if found is not None:
                pass
            elif word in self.special:
                found = (1, b",%d" % self.special[word], word.encode())
            else:
                ids = self.encode_word(word)
                found = (len(ids), b"".join([b",%d" % i for i in ids]), self.decode_bytes(ids))
            if len(self.words) >= WORDS_KEPT:
                self.words, self.older = {}, self.words
            self.words[word] = found
        return found

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, digest of the ids and digest of the decoded text."""
        count, ids, back = 0, hashlib.sha256(), hashlib.sha256()
        lead = 1  # the first comma is left out
        tail = b""
        for part, is_special in self.segments(text):
            words = [part] if is_special else self.pattern.findall(part)
            found = [self.words.get(w) or self.known(w) for w in words]
            count += sum([f[0] for f in found])
            ids.update(b"".join([f[1] for f in found])[lead:])
            lead = 0
            tail += b"".join([f[2] for f in found])
        back.update(tail.decode("utf-8", "replace").encode("utf-8"))
        return count, ids.hexdigest(), back.hexdigest()


@cache
def codec(path: str) -> Codec:
    """One codec a worker and vocabulary file."""
    return Codec(path)


def encode_texts(documents: DataFrame, vocabulary: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``documents`` with the ids of each text in the array column ``out``."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = codec(vocabulary)
        for texts in batches:
            yield texts.map(lambda t: encoder.encode(t or ""))

    return documents.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decode_ids(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids in the column ``out``; null ids are no ids."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = codec(vocabulary)
        for lists in batches:
            yield lists.map(lambda x: decoder.decode([] if x is None else list(x)))

    return rows.withColumn(out, texts(F.col(ids)))


def round_trip(documents: DataFrame, vocabulary: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded and decoded again.

    Ids never leave the task: their decimals, joined by commas, and the decoded text go into
    their digests as they are made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = codec(vocabulary)
        for batch in batches:
            told = [encoder.digests(t) for t in batch.column(1).to_pylist()]
            counts, ids, back = zip(*told) if told else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, DIGEST)
