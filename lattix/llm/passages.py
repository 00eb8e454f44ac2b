"""Substring deduplication by automata of recurring passages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import SPACE, mapped, pieces, text_bytes, word_spans
from lattix.llm.repeats import NO_ID, Units, removed_items, repeated_spans

WINDOW, GRAM = 20, 6
#: Windows that one automaton is compiled from; a shard with more has several.
PATTERNS = 60_000


def _later_occurrences(window: int):
    def find(rows: dict) -> list[tuple[int, int, int, int]]:
        """Confirms which windows of a shard recur, compiles them, and streams the shard's segments through."""
        ids: dict[bytes, int] = {}
        number = ids.setdefault
        streams = [tuple([number(w, len(ids)) for w in s.split(b" ")]) for s in rows["segment"]]
        owners = list(zip(rows["doc_id"], rows["th"], rows["at"], strict=True))
        first: dict[tuple, tuple[int, int, int]] = {}
        recurring: dict[tuple, None] = {}
        for stream, (doc, th, at) in zip(streams, owners, strict=True):
            for k in range(len(stream) - window + 1):
                gram, owner = stream[k : k + window], (doc, th, at + k)
                known = first.setdefault(gram, owner)
                if known is not owner and known != owner:
                    recurring[gram] = None
                    if owner < known:
                        first[gram] = owner
        patterns = list(recurring)
        out = []
        for begin in range(0, len(patterns), PATTERNS):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for gram in patterns[begin : begin + PATTERNS]:
                automaton.add_word(gram, first[gram])
            automaton.make_automaton()
            for stream, (doc, th, at) in zip(streams, owners, strict=True):
                start = end = -1
                for last, known in automaton.iter(stream):
                    place = at + last - window + 1
                    if (doc, th, place) > known:
                        if place > end:
                            if end >= 0:
                                out.append((doc, th, start, end))
                            start = place
                        end = place + window
                if end >= 0:
                    out.append((doc, th, start, end))
        return out

    return find


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and kept, the words that stay, joined by spaces.

    A word goes if a window of ``window`` words around it also starts earlier: in a document with a smaller id, or before in its own.
    Recurring anchors pick the windows that can recur; their segments go to the shard of the anchor, where the recurring
    ones are confirmed word by word and compiled, and all segments of the shard stream through the automaton; windows of
    an anchor with very many segments are counted by digests. Ids are integers.
    Null and empty texts have no words. Rows of one id are told apart by a hash of their texts, which also orders them;
    a row that is repeated as a whole is one document, returned each time. Other columns are not read.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts, spans = repeated_spans(own, Units(window, min(GRAM, window), True), _later_occurrences(window), first_stays=True)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = text_bytes(batch["text"])
            starts, ends, rows = word_spans(data, offsets, SPACE)
            sizes = np.bincount(rows, minlength=batch.num_rows)
            gone = removed_items(batch["spans"].to_pylist(), sizes, np.searchsorted(rows, np.arange(batch.num_rows)), window)
            left = []
            for row, text in enumerate(batch["text"].cast(pa.large_binary()).to_pylist()):
                words = (text or b"").split()
                a = int(np.searchsorted(rows, row))
                mask = gone[a : a + len(words)]
                left.append(b" ".join([w for w, g in zip(words, mask.tolist(), strict=True) if not g] if mask.any() else words))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"], "n_words": pa.array(sizes.astype(np.int64)), "n_removed": pa.array(np.bincount(rows[gone], minlength=batch.num_rows).astype(np.int64)),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in left]), "kept": pa.array([x.decode() for x in left], pa.string()),
            })

    return mapped(texts.join(spans, ["doc_id", "th"], "left").select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", "spans"), kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")


OP4_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS g FROM starts),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM ranked WHERE r > 1),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM docs),
kept AS (SELECT doc_id, string_agg(w[j], ' ' ORDER BY j) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""
