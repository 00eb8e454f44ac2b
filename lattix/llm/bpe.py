"""Byte-pair encoding of many byte strings at once, token counts, and encoding with decoding."""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from lattix.llm.batches import mapped, pieces

#: Strings whose tokens a worker remembers between batches; when full it starts anew. Longer strings aren't remembered.
REMEMBERED, REMEMBERED_LENGTH = 300_000, 64
#: Cells of a padded matrix.
CELLS = 1_000_000
_NONE = np.int32(2**31 - 1)


class Merges:
    """A vocabulary given by the bytes of each id, ids in order of merging: a pair merges if its bytes have an id."""

    def __init__(self, tokens: list[bytes], pairs: list[tuple[int, int, int]] | None = None):
        self.tokens = tokens
        ids = {b: k for k, b in enumerate(tokens)}
        self.of_byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        if pairs is None:
            pairs = [(ids[b[:k]], ids[b[k:]], i) for i, b in enumerate(tokens) if len(b) > 1 for k in range(1, len(b)) if b[:k] in ids and b[k:] in ids]
            ranks = [i for _, _, i in pairs]
        else:
            ranks = list(range(len(pairs)))
        self.n = len(tokens)
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # a hashed table of pairs: open addressing in rounds, at most a quarter full
        self.bits = max(4, (4 * len(left)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.rank, self.made = np.full(size, _NONE, np.int32), np.zeros(size, np.int32)
        keys, todo, self.probes = left * self.n + right, np.arange(len(left)), 0
        ranks_, made = np.array(ranks, np.int32), made.astype(np.int32)
        while len(todo):
            slots = self._slot(keys[todo], self.probes)
            free = self.keys[slots] < 0
            first = np.full(size, -1, np.int64)
            first[slots[free][::-1]] = todo[free][::-1]
            won = first[slots] == todo
            at = slots[won]
            self.keys[at], self.rank[at], self.made[at] = keys[todo[won]], ranks_[todo[won]], made[todo[won]]
            todo = todo[~won]
            self.probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys.astype(np.uint64) + np.uint64(probe * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; the rank of none is the largest integer."""
        keys = left.astype(np.int64) * self.n + right
        slots = self._slot(keys, 0)
        hit = self.keys[slots] == keys
        rank, made = np.where(hit, self.rank[slots], _NONE), self.made[slots]
        for probe in range(1, self.probes):
            miss = np.flatnonzero(rank == _NONE) if probe == 1 else miss[rank[miss] == _NONE]
            if not len(miss):
                break
            slots = self._slot(keys[miss], probe)
            good = self.keys[slots] == keys[miss]
            rank[miss[good]], made[miss[good]] = self.rank[slots[good]], self.made[slots[good]]
        return rank, made

    def _matrix(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of strings of about one length: padded rows of ids, and how many of each row count."""
        lengths = np.array([len(s) for s in strings], np.int64)
        wide = int(lengths.max())
        flat = self.of_byte[np.frombuffer(b"".join(strings), np.uint8)]
        ids = np.full((len(strings), wide + 1), -1, np.int32)
        ids[np.arange(wide + 1) < lengths[:, None]] = flat
        both = ids[:, 1:] >= 0
        rank = np.full((len(strings), wide), _NONE, np.int32)
        made = np.zeros((len(strings), wide), np.int32)
        rank[both], made[both] = self.lookup(ids[:, :-1][both], ids[:, 1:][both])
        done = np.full((len(strings), wide), -1, np.int32)
        counts = lengths.copy()
        live = np.arange(len(strings))
        while len(live):
            at = rank.argmin(1)
            row = np.arange(len(live))
            ends = rank[row, at] == _NONE
            if ends.any():  # finished rows leave the matrix
                gone = live[ends]
                done[gone, : ids.shape[1] - 1] = ids[ends, :-1]
                counts[gone] = (ids[ends] >= 0).sum(1)
                keep = ~ends
                live, ids, rank, made, at = live[keep], ids[keep], rank[keep], made[keep], at[keep]
                if not len(live):
                    break
                row = np.arange(len(live))
            ids[row, at] = made[row, at]
            width = ids.shape[1]
            move = np.arange(width - 1)
            later = move > at[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ids = ids[:, :-1]  # a column less: each live row lost one
            rank = np.where(move[:-1] > at[:, None], rank[:, 1:], rank[:, :-1])
            made = np.where(move[:-1] > at[:, None], made[:, 1:], made[:, :-1])
            if not rank.shape[1]:
                done[live, 0], counts[live] = ids[:, 0], 1
                break
            for shift in (-1, 0):
                spot = at + shift
                good = np.flatnonzero((spot >= 0) & (spot < rank.shape[1]))
                if not len(good):
                    continue
                where = spot[good]
                a, b = ids[good, where], ids[good, where + 1]
                r, m = self.lookup(np.maximum(a, 0), np.maximum(b, 0))
                rank[good, where], made[good, where] = np.where((a >= 0) & (b >= 0), r, _NONE), m
        return done, counts

    def _long(self, string: bytes) -> np.ndarray:
        """One long string: a heap of pairs over a linked list, n log n."""
        from heapq import heapify, heappop, heappush

        ids = self.of_byte[np.frombuffer(string, np.uint8)]
        rank, made = self.lookup(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(ids)
        after, before, heap = [*range(1, n), -1], [-1, *range(n - 1)], [(r, k, m, ids[k], ids[k + 1]) for k, (r, m) in enumerate(zip(rank.tolist(), made.tolist(), strict=True)) if r != _NONE]
        heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def offer(k: int) -> None:
            pair = ids[k], ids[after[k]]
            if pair not in known:
                r, m = self.lookup(np.array([pair[0]]), np.array([pair[1]]))
                known[pair] = int(r[0]), int(m[0])
            r, m = known[pair]
            if r != _NONE:
                heappush(heap, (r, k, m, *pair))

        while heap:
            _, k, m, a, b = heappop(heap)
            follow = after[k]
            if ids[k] != a or follow < 0 or ids[follow] != b:
                continue
            ids[k], ids[follow] = m, -1
            after[k] = after[follow]
            if after[k] >= 0:
                before[after[k]] = k
                offer(k)
            if before[k] >= 0:
                offer(before[k])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, strings: list[bytes]) -> list[np.ndarray]:
        """The ids of each string, every one merged by itself: in buckets of like length, rows padded, a merge a round."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(strings)
        lengths = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(lengths, kind="stable")
        first = int(np.searchsorted(lengths[order], 1))
        while first < len(order):
            low = int(lengths[order[first]])
            if low > 1024:
                for k in order[first:].tolist():
                    out[k] = self._long(strings[k])
                break
            last = int(np.searchsorted(lengths[order], max(low, low * 5 // 4), side="right"))
            last = min(last, first + max(1, CELLS // (low * 5 // 4 + 1)), int(np.searchsorted(lengths[order], 1024, side="right")))
            bucket = order[first:last].tolist()
            ids, counts = self._matrix([strings[k] for k in bucket])
            for k, row, n in zip(bucket, ids, counts.tolist(), strict=True):
                out[k] = row[:n]
            first = last
        return out


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(4)
def ranked(path: str) -> Merges:
    """A file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Merges(sorted(ranks, key=ranks.get))


@lru_cache(4)
def listed(path: str) -> tuple[Merges, tuple[str, ...], str]:
    """A JSON file with vocabulary and merges: merges, the special strings, and the pattern that splits texts."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters = _byte_letters()
    special = {t["id"]: t["content"] for t in told["added_tokens"]}
    vocabulary = {word: k for word, k in told["model"]["vocab"].items() if k not in special}
    as_bytes = lambda word: bytes(letters[c] for c in word)
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for word, k in vocabulary.items():
        tokens[k] = as_bytes(word)
    split = (m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"])
    pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in split]
    pre = told["pre_tokenizer"]
    if told["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
        raise ValueError(f"{path}: only plain byte-level vocabularies are counted")
    return Merges(tokens, pairs), tuple(special.values()), "byte-level"


@lru_cache(4)
def lone_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings that are proven to encode alone as one token: each was merged from its bytes.

    Only those that the pattern keeps in one piece and that are valid UTF-8: others never are a whole pre-token.
    """
    merges, _, _ = listed(path)
    texts = {}
    for k, b in enumerate(merges.tokens):
        try:
            texts[k] = b.decode()
        except UnicodeDecodeError:
            continue
    split = splitter()
    whole = [k for k, s in texts.items() if s and split.findall(s) == [s]]
    return frozenset(texts[k] for k, ids in zip(whole, merges.encode([merges.tokens[k] for k in whole]), strict=True) if ids.tolist() == [k])


@lru_cache(1)
def splitter() -> regex.Pattern:
    from public_tokenizers import PATTERN

    return regex.compile(PATTERN)


class TokenCounter:
    """Counts per pre-token: one for those proven to be one token, else by merging; new ones are merged together."""

    def __init__(self, path: str):
        self.merges, special, _ = listed(path)
        self.proven = lone_tokens(path)
        self.known: dict[str, int] = dict.fromkeys(self.proven, 1)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.markers = special

    def count(self, texts: list[str]) -> list[int]:
        split, extra, tokens = splitter().findall, [], []
        for text in texts:
            if self.special and any(m in text for m in self.markers):
                parts = self.special.split(text)
                extra.append(len(parts) - 1)
                tokens.append([t for part in parts for t in split(part)])
            else:
                extra.append(0)
                tokens.append(split(text))
        new = set().union(*tokens).difference(self.known)
        passing = {}
        if new:
            strings = list(new)
            for s, ids in zip(strings, self.merges.encode([s.encode() for s in strings]), strict=True):
                (self.known if len(s) <= REMEMBERED_LENGTH else passing)[s] = len(ids)
        get = (self.known | passing if passing else self.known).__getitem__
        out = [e + sum(map(get, t)) for e, t in zip(extra, tokens, strict=True)]
        if len(self.known) > REMEMBERED + len(self.proven):
            self.known = dict.fromkeys(self.proven, 1)
        return out


@lru_cache(2)
def _counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens by the byte-level BPE file at ``path``, over_limit.

    Special strings inside texts are one token each, none is added. Each row is counted alone, without a shuffle: null and empty texts have 0,
    repeated rows and rows without an id are counted each, other columns are not read; an empty table gives none. Of
    pairs with one rank the leftmost merges first.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in pieces(batches, "text"):
            texts = batch["text"].fill_null("")
            n = np.array(counter.count(texts.to_pylist()), np.int64)
            size = np.array([len(x) for x in texts.cast(pa.binary()).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


class Codec:
    """Texts to ids and back by a rank file."""

    def __init__(self, path: str):
        self.merges = ranked(path)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = splitter().findall
        tokens = [split(t) for t in texts]
        new = list(set().union(*tokens).difference(self.known))
        passing = {}
        for s, ids in zip(new, self.merges.encode([s.encode() for s in new]), strict=True):
            (self.known if len(s) <= REMEMBERED_LENGTH else passing)[s] = ids.astype("<u4").tobytes()
        get = (self.known | passing if passing else self.known).__getitem__
        out = [b"".join(map(get, t)) for t in tokens]
        if len(self.known) > REMEMBERED:
            self.known = {}
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def _codec(path: str) -> Codec:
    return Codec(path)


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and if asked the ids (little-endian, 4 bytes each).

    Each match of the pattern is merged separately, without special tokens; the ids are decoded again from the
    vocabulary. Each row alone, without a shuffle: null and empty texts have no ids, repeated rows and rows without an
    id are encoded each, other columns are not read; an empty table gives none. Of pairs with one rank the leftmost
    merges first. Matches of over 1,024 bytes leave the matrices for a heap of their pairs, which gives the same ids.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, digest = _codec(path), lambda x: hashlib.sha256(x).hexdigest()
        for batch in pieces(batches, "text"):
            ids = codec.encode(batch["text"].fill_null("").to_pylist())
            columns = {"doc_id": batch["doc_id"], "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": pa.array([digest(x) for x in ids]), "decoded_sha256": pa.array([digest(codec.decode(x)) for x in ids])}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return mapped(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), coded, schema)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
