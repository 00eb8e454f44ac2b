"""Repeated byte strings by a depth-limited radix sort of suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import RollingHash, mapped, pieces, text_bytes
from lattix.llm.repeats import NO_ID, Units, removed_items, repeated_spans

WINDOW, GRAM = 400, 64
#: Suffixes that are sorted at once; runs of one anchor stay together.
AT_ONCE = 3_000_000
#: Digits after the first: so many bytes each, told apart by 64-bit hashes until whole windows are compared.
DIGIT = 49


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Whether the n bytes from each of ``a`` are those from ``b``."""
    width = min(8, n)
    heads = np.ndarray((max(0, len(data) - width + 1),), f"V{width}", data, strides=(1,)) if width < 8 else np.ndarray((max(0, len(data) - 7),), np.uint64, data, strides=(1,))
    same = np.ones(len(a), np.bool_)
    for at in dict.fromkeys([*range(0, n - width + 1, width), n - width]):
        same &= heads[a + at] == heads[b + at]
    return same


def _same_bytes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Which suffixes, in order of their groups, share their first bytes with another of the group, byte for byte."""
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(group)))
    head = np.repeat(first, sizes)
    same = np.concatenate([_equal(data, starts[a : a + 500_000], starts[head[a : a + 500_000]], depth) for a in range(0, len(starts), 500_000)] or [np.zeros(0, np.bool_)])
    good = np.repeat(np.logical_and.reduceat(same, first), sizes) if len(first) else same
    for a, n in zip(first.tolist(), sizes.tolist(), strict=True) if not good.all() else ():  # hashes of digits that met by chance
        if not good[a]:
            own = [data[s : s + depth].tobytes() for s in starts[a : a + n].tolist()]
            good[a : a + n] = [own.count(x) > 1 for x in own]
    return good


def repeated_suffixes(groups: np.ndarray, data: np.ndarray, starts: np.ndarray, twice: np.ndarray, depth: int) -> np.ndarray:
    """Which suffixes share their first ``depth`` bytes with another of their group, or count twice themselves.

    Passes from the most significant digit: the first of eight bytes, further ones of ``DIGIT`` bytes. After each,
    suffixes alone in their group leave, and only groups whose digits differ are ordered anew; in the end each group is
    compared byte for byte. ``groups`` holds integers.
    """
    out = twice.copy()
    alive = np.arange(len(starts))
    group = groups
    hashed = RollingHash(data)
    head = np.ndarray((max(0, len(data) - 7),), ">u8", data.tobytes(), strides=(1,))
    done = 0
    while len(alive):
        size = min(8 if not done else DIGIT, depth - done)
        at = starts[alive] + done
        digit = head[at].astype(np.uint64) if size == 8 else hashed(at, at + size)
        if not done:
            order = np.lexsort((digit, group))
            alive, group, digit = alive[order], group[order], digit[order]
        new = np.ones(len(alive), np.bool_)
        new[1:] = group[1:] != group[:-1]
        label = np.cumsum(new) - 1
        if done:
            mixed = np.zeros(int(label[-1]) + 1, np.bool_)
            mixed[label[1:][(digit[1:] != digit[:-1]) & ~new[1:]]] = True
            part = np.flatnonzero(mixed[label])
            order = np.lexsort((digit[part], label[part]))
            alive[part], digit[part] = alive[part][order], digit[part][order]
        new[1:] |= digit[1:] != digit[:-1]
        ends = np.flatnonzero(new)
        sizes = np.diff(np.append(ends, len(alive)))
        keep = np.repeat(sizes > 1, sizes)
        alive, group = alive[keep], (np.cumsum(new) - 1)[keep]
        done += size
        if done == depth:
            out[alive[_same_bytes(data, starts[alive], group, depth)]] = True
            break
    return out


def _repeats(window: int):
    def find(rows: dict) -> list[tuple[int, int, int, int]]:
        anchors = np.array(rows["anchor"], np.int64)
        order = np.argsort(anchors, kind="stable")
        lengths = np.array([len(s) for s in rows["segment"]], np.int64)[order]
        anchors = anchors[order]
        windows = lengths - window + 1
        new = np.concatenate([[True], anchors[1:] != anchors[:-1]])
        out = []
        begin = 0
        while begin < len(order):
            end = begin + max(1, int(np.searchsorted(np.cumsum(windows[begin:]), AT_ONCE, side="right")))
            while end < len(order) and not new[end]:
                end += 1
            part = order[begin:end]
            data = np.frombuffer(b"".join([rows["segment"][k] for k in part.tolist()]), np.uint8)
            base = np.concatenate([[0], np.cumsum(lengths[begin:end])])
            count = windows[begin:end]
            of = np.repeat(np.arange(len(part)), count)
            inside = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            twice = np.array([rows["copied"][k] for k in part.tolist()], np.bool_)[of]
            hit = repeated_suffixes(np.cumsum(new[begin:end])[of], data, base[of] + inside, twice, window)
            cuts = np.ones(len(of), np.bool_)
            cuts[1:] = (hit[1:] != hit[:-1]) | (of[1:] != of[:-1])
            first = np.flatnonzero(cuts)
            last = np.append(first[1:], len(of)) - 1
            for a, b in zip(first[hit[first]].tolist(), last[hit[first]].tolist(), strict=True):
                k = part[of[a]]
                at = rows["at"][k]
                if not rows["copied"][k]:
                    out.append((rows["doc_id"][k], rows["th"][k], at + int(inside[a]), at + int(inside[b]) + window))
            begin = end
        return out

    return find


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept, the bytes that stay.

    A byte goes if a string of ``window`` bytes around it also starts anywhere else, in any document or its own. Only
    windows whose anchor recurs are cut out; their suffixes are sorted by the first ``window`` bytes in the shard of
    the anchor; those of an anchor with very many segments are counted by digests of the windows. Ids are integers. Null and empty texts have no bytes; rows of one id are told apart by a hash of their texts; a row
    that is repeated as a whole counts as a copy of itself. Other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts, spans = repeated_spans(own, Units(window, min(GRAM, window), False), _repeats(window), first_stays=False)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = text_bytes(batch["text"])
            sizes = np.diff(offsets)
            gone = removed_items(batch["spans"].to_pylist(), sizes, offsets[:-1], window)
            rows = np.repeat(np.arange(batch.num_rows), sizes)
            runs = gone.copy()
            runs[1:] &= ~gone[:-1] | (rows[1:] != rows[:-1])
            left = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            count = lambda mask: pa.array(np.bincount(rows[mask], minlength=batch.num_rows).astype(np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n_bytes": pa.array(sizes.astype(np.int64)), "n_removed": count(gone), "n_spans": count(runs),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left]), "kept": pa.array(left, pa.binary()),
            })

    return mapped(texts.join(spans, ["doc_id", "th"], "left").select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", "spans"), kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")
