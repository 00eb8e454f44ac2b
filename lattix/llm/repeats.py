"""Windows that recur anywhere in a corpus, found without comparing or gathering all of them.

Every window of W items (words or bytes) is represented by the least hash of its k-item grams. Neighbouring windows
mostly share that gram, so a run of them is told by one hash: its anchor. Equal windows have equal anchors. So

1. anchors of all texts are counted in shards; a task sends each anchor once for a piece of text, however often it holds it;
2. texts are joined with their recurring anchors, and only runs with those are cut out as segments;
3. segments go to the shard of their anchor, where a caller's function finds the windows that recur exactly;
4. spans come back to the texts.

Exact copies of whole texts are settled by a digest before, and only one copy takes part. An anchor of very many
segments would fill one shard: its windows meet within each task first, and one of each kind is dealt, by digests of their
own, and counted in DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattix.llm.batches import MORE_CODES, SPACE, RollingHash, mapped, mixed, pieces, stretches, text_bytes, told_by, window_hashes, word_spans, written

#: Bytes of text that fall to one shard.
SHARD_BYTES = 2_000_000
#: Segments of one anchor from which its windows are dealt one by one, or the bytes of all texts by ``HOT_SHARE`` if those are more.
#: A text has about a run of windows per 150 bytes, so such anchors are few millions at most at any size.
HOT_SEGMENTS, HOT_SHARE = 3_000, 200_000_000
#: Windows of such anchors that a task holds at once.
SETTLED = 500_000
#: The span that stands for a whole text.
WHOLE = 1 << 40
#: Stands for a null id.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Units:
    """What windows are made of: ``window`` items, told by grams of ``gram`` items."""

    window: int
    gram: int
    words: bool

    def cut(self, texts: pa.Array) -> Cut:
        return Cut(self, texts)


def _slide(a: np.ndarray, m: int, pick: np.ufunc, pad: int) -> np.ndarray:
    """The least (or greatest) of every m consecutive values, in time that does not depend on m."""
    n = len(a)
    if n < m:
        return a[:0]
    full = np.full(-(-n // m) * m, pad, a.dtype)
    full[:n] = a
    blocks = full.reshape(-1, m)
    ahead = pick.accumulate(blocks, axis=1).reshape(-1)
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(behind[: n - m + 1], ahead[m - 1 : n])


_TOP = np.iinfo(np.uint64).max


class Cut:
    """Items of a batch of texts and the runs of windows with one anchor."""

    def __init__(self, units: Units, texts: pa.Array):
        data, offsets = text_bytes(texts)
        w, k, n = units.window, units.gram, len(texts)
        m = w - k + 1
        hashed = RollingHash(data)
        if units.words:
            starts, ends, rows = word_spans(data, offsets, SPACE)
            grams = window_hashes(hashed(starts, ends), k)
            sizes = ends - starts
            self.at = np.concatenate([[0], np.cumsum(sizes + 1)])  # where each word begins once one space follows each
            self.flat = np.full(int(self.at[-1]), 32, np.uint8)
            inside = np.ones(len(self.flat), np.bool_)
            inside[self.at[1:] - 1] = False
            self.flat[inside] = data[~SPACE[data]]
            self.gap = 1
        else:
            rows = np.repeat(np.arange(n), np.diff(offsets))
            at = np.arange(max(0, len(data) - k + 1))
            grams = hashed(at, at + k)
            self.flat, self.gap, self.at = data, 0, None
        self.rows = rows
        self.first = np.searchsorted(rows, np.arange(n))
        self.size = np.bincount(rows, minlength=n)
        least = _slide(grams, m, np.minimum, _TOP)
        good = rows[: len(least)] == rows[w - 1 :] if len(least) else np.zeros(0, np.bool_)
        spots = np.zeros(len(grams), np.uint64)  # of the windows around each gram, the greatest anchor
        if len(least):
            spots[:] = _slide(np.concatenate([np.zeros(m - 1, np.uint64), np.where(good, least, 0), np.zeros(m - 1, np.uint64)]), m, np.maximum, 0)
        step = np.ones(len(least), np.bool_)
        own = rows[: len(least)]
        step[1:] = (least[1:] != least[:-1]) | ~good[:-1] | (own[1:] != own[:-1])
        begin = np.flatnonzero(step & good)
        stop = np.ones(len(least), np.bool_)
        stop[:-1] = step[1:] | ~good[1:]
        self.begin, self.end = begin, np.flatnonzero(stop & good) + w  # items of a run: [begin, end)
        self.anchor = least[begin]
        self.row = rows[begin]
        # a gram that anchors windows of one text from two places may hold equal windows within one text
        place = np.flatnonzero((spots == grams) & (spots > 0))
        own = grams[place] ^ mixed(rows[place].astype(np.uint64))
        seen, times = np.unique(own, return_counts=True)
        twice = seen[times > 1]
        self.own = self.anchor ^ mixed(self.row.astype(np.uint64))
        self.self_repeated = np.isin(self.own, twice)

    def segment(self, k: int) -> bytes:
        a, b = self.begin[k], self.end[k]
        return self.flat[a:b].tobytes() if self.at is None else self.flat[self.at[a] : self.at[b] - 1].tobytes()


    def windows(self, runs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Run, first item and bounds in ``flat`` of every window of the runs."""
        count = self.end[runs] - self.begin[runs] - size + 1
        of = np.repeat(runs, count)
        first = self.begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        bounds = np.stack([first, first + size]) if self.at is None else np.stack([self.at[first], self.at[first + size] - 1])
        return of, first, bounds


def _packed(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    for a, b in stretches(ranked):
        yield int(ranked[a]), order[a:b]


def _to_shard(anchors: np.ndarray, shards: int) -> np.ndarray:
    return ((anchors >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


_ASK = ["shard", "doc_id", "th", "anchors", "known", "ids", "ths", "times"]


def _asking(units: Units, shards: int) -> Callable:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            cut = units.cut(batch["text"])
            ids, ths = batch["doc_id"].to_numpy().astype(np.int64), batch["th"].to_numpy()
            th = ths[cut.row]
            kinds, of = np.unique(cut.anchor, return_inverse=True)
            low, high = np.full(len(kinds), np.iinfo(np.int64).max), np.full(len(kinds), np.iinfo(np.int64).min)
            np.minimum.at(low, of, th)
            np.maximum.at(high, of, th)
            least = np.full(len(kinds), np.iinfo(np.int64).max)  # of copies of one text the smallest id takes part
            np.minimum.at(least, of, ids[cut.row])
            times = np.bincount(of, minlength=len(kinds))
            known = low != high
            known[of[cut.self_repeated]] = True
            out: list[tuple] = []
            sure = np.flatnonzero(known[of])
            for row, at in _packed(cut.row[sure]):  # these need no answer; they pass through any shard
                out.append((int(ids[row]) % shards, int(ids[row]), int(ths[row]), np.unique(cut.anchor[sure[at]]).tobytes(), None, None, None, None))
            for shard, at in _packed(_to_shard(kinds, shards)):
                out.append((shard, None, None, kinds[at].tobytes(), known[at].tobytes(), least[at].tobytes(), low[at].tobytes(), times[at].tobytes()))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 8, types, strict=True)], _ASK)

    return ask


def _answering(hot: int) -> Callable:
    """An anchor recurs if a task knew it to, or if texts that differ hold it. Those of ``hot`` segments come back in rows without an id."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []

        def out() -> list[tuple[int | None, int | None, bytes]]:
            if not parts:
                return []
            anchors, known, ids, ths, times = (np.concatenate([np.frombuffer(p[k], d) for p in parts]) for k, d in enumerate((np.uint64, np.bool_, np.int64, np.int64, np.int64)))
            parts.clear()
            order = np.argsort(anchors, kind="stable")
            anchors, known, ids, ths, times = anchors[order], known[order], ids[order], ths[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
            large = anchors[first][np.add.reduceat(times, first) >= hot]
            recurs = np.logical_or.reduceat(known, first) | (np.minimum.reduceat(ths, first) != np.maximum.reduceat(ths, first))
            again = np.repeat(recurs, np.diff(np.append(first, len(anchors)))) & ~known
            anchors, ids, ths = anchors[again], ids[again], ths[again]
            order = np.lexsort((ths, ids))
            anchors, ids, ths = anchors[order], ids[order], ths[order]
            told: list[tuple[int | None, int | None, bytes]] = [(None, None, large.tobytes())] if len(large) else []
            return told + [(int(ids[a]), int(ths[a]), anchors[a:b].tobytes()) for a, b in stretches(ids, ths)]

        def batch_of(rows: list[tuple[int | None, int | None, bytes]]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "th", "anchors"])

        for batch in batches:
            passing = batch.filter(batch["doc_id"].is_valid())
            if passing.num_rows:
                yield passing.select(["doc_id", "th", "anchors"])
            asked = batch.filter(batch["doc_id"].is_null())
            for s, *part in zip(asked["shard"].to_pylist(), *(asked[c].to_pylist() for c in ("anchors", "known", "ids", "ths", "times")), strict=True):
                if s != shard:
                    yield batch_of(out())
                    shard = s
                parts.append(part)
        yield batch_of(out())

    return answer


def _wanted(cut: Cut, batch: pa.RecordBatch) -> np.ndarray:
    """The runs of windows whose anchors a text was told to recur."""
    lists = [b"".join(x) for x in batch["anchors"].to_pylist()]
    told = np.frombuffer(b"".join(lists), np.uint64) ^ mixed(np.repeat(np.arange(batch.num_rows, dtype=np.uint64), [len(x) // 8 for x in lists]))
    return np.flatnonzero(np.isin(cut.own, told))


def _segments(units: Units, shards: int, hot: np.ndarray) -> Callable:
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1_000_000):
            cut = units.cut(batch["text"])
            runs = _wanted(cut, batch)
            runs = runs[~np.isin(cut.anchor[runs], hot)]
            rows = pa.array(cut.row[runs])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_to_shard(cut.anchor[runs], shards).astype(np.int32)), pa.array(cut.anchor[runs].view(np.int64)), batch["doc_id"].take(rows), batch["th"].take(rows), batch["copied"].take(rows),
                 pa.array(cut.begin[runs] - cut.first[cut.row[runs]]), pa.array([cut.segment(k) for k in runs.tolist()], pa.binary())],
                ["shard", "anchor", "doc_id", "th", "copied", "at", "segment"],
            )

    return cut_out


def _settled(held: list[tuple[np.ndarray, ...]], window: int, first_stays: bool) -> pa.RecordBatch:
    """Of windows (one, two, doc_id, th, at) the first of each kind, to be asked about, and spans of those that go whatever other tasks hold."""
    columns = [np.concatenate(c) for c in zip(*held, strict=True)]
    order = np.lexsort(columns[::-1])
    one, two, doc, th, at = (c[order] for c in columns)
    new = np.ones(len(order), np.bool_)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    asked = np.flatnonzero(new)
    sizes = np.diff(np.append(asked, len(order)))
    head = np.repeat(asked, sizes)
    gone = (doc != doc[head]) | (th != th[head]) | (at != at[head]) if first_stays else np.repeat(sizes > 1, sizes)
    d, t, a = doc[gone], th[gone], at[gone]
    order = np.lexsort((a, t, d))
    d, t, a = d[order], t[order], a[order]
    cuts = np.ones(len(a), np.bool_)
    cuts[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (a[1:] > a[:-1] + window)
    begin = np.flatnonzero(cuts)
    until = a[np.append(begin[1:], len(a)) - 1] + window if len(a) else a
    asks, spans = pa.nulls(len(asked), pa.int64()), pa.nulls(len(begin), pa.int64())
    both = lambda x, y: pa.concat_arrays([pa.array(x), pa.array(y)])
    return pa.RecordBatch.from_arrays(
        [both(one[asked], spans), both(two[asked], spans), both(doc[asked], d[begin]), both(th[asked], t[begin]), both(at[asked], a[begin]), both(asks, until)],
        ["one", "two", "doc_id", "th", "at", "until"],
    )


def _hot_windows(units: Units, hot: np.ndarray, first_stays: bool) -> Callable:
    """Windows of the anchors ``hot``, told by 128 bits. Those of one task meet there: it sends one of each kind, and spans of the others."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in pieces(batches, "text", 200_000):
            cut = units.cut(batch["text"])
            of, first, (a, b) = cut.windows(np.flatnonzero(np.isin(cut.anchor, hot)), units.window)
            rows = cut.row[of]
            ids, ths = (batch[c].to_numpy().astype(np.int64)[rows] for c in ("doc_id", "th"))
            held.append((RollingHash(cut.flat)(a, b).view(np.int64), RollingHash(cut.flat, MORE_CODES)(a, b).view(np.int64), ids, ths, (first - cut.first[rows]).astype(np.int64)))
            n += len(of)
            if n >= SETTLED:
                yield _settled(held, units.window, first_stays)
                held, n = [], 0
        if n:
            yield _settled(held, units.window, first_stays)

    return each


def _by_shard(find: Callable[[dict], list[tuple[int, int, int, int]]]) -> Callable:
    """``find`` gets the columns of one shard as lists and gives spans (doc_id, th, from, to) in items."""
    names = ["anchor", "doc_id", "th", "copied", "at", "segment"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, {c: [] for c in names}

        def out() -> pa.RecordBatch:
            spans = find(rows) if rows["at"] else []
            for c in names:
                rows[c] = []
            columns = list(zip(*spans, strict=True)) if spans else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "th", "a", "b"])

        for batch in batches:
            shards = batch["shard"].to_numpy()
            for a, b in stretches(shards):
                if shards[a] != shard:
                    yield out()
                    shard = shards[a]
                part = batch.slice(a, b - a)
                for c in names:
                    rows[c] += part[c].to_pylist()
        yield out()

    return found


def repeated_spans(docs: DataFrame, units: Units, find: Callable, first_stays: bool) -> tuple[DataFrame, DataFrame]:
    """Texts (doc_id, th, text) and the spans to remove from them: (doc_id, th, spans), where there are any.

    th is a hash of the text; copies agree in a digest as well. With ``first_stays`` the copy of a text with the smallest id is not removed, otherwise no
    copy stays; a span up to ``WHOLE`` is a whole text.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("th", F.xxhash64("text"))
    ids = written(keyed.select("doc_id", "th", F.unhex(F.md5("text")).alias("digest"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")))
    total = ids.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * SHARD_BYTES)))

    asked = mapped(keyed.where("text IS NOT NULL").select("doc_id", "th", "text"), _asking(units, shards), "shard int, doc_id long, th long, anchors binary, known binary, ids binary, ths binary, times binary")
    answers = mapped(asked.repartition(parts, "shard").sortWithinPartitions("shard"), _answering(max(HOT_SEGMENTS, total // HOT_SHARE)), "doc_id long, th long, anchors binary")
    copies = written(ids.groupBy("th", "digest").agg(F.min("doc_id").alias("one"), F.count("*").alias("n")).where("n > 1 AND digest IS NOT NULL"))
    wanted = written(answers.groupBy("doc_id", "th").agg(F.collect_list("anchors").alias("anchors")))
    hot = np.frombuffer(b"".join(x for r in wanted.where("doc_id IS NULL").collect() for x in r["anchors"]), np.uint64)
    wanted = wanted.where("doc_id IS NOT NULL").join(copies, "th", "left").where("one IS NULL OR doc_id = one").select("doc_id", "th", "anchors", F.col("one").isNotNull().alias("copied"))

    texts = keyed.select("doc_id", "th", "text").repartition(parts, "doc_id", "th")
    cut = mapped(texts.where("text IS NOT NULL").join(wanted, ["doc_id", "th"]), _segments(units, shards, hot), "shard int, anchor long, doc_id long, th long, copied boolean, at long, segment binary")
    spans = mapped(cut.repartition(parts, "shard").sortWithinPartitions("shard"), _by_shard(find), "doc_id long, th long, a long, b long")
    if len(hot):  # here copies take part as they are: those that go, go as a whole anyway
        windows = written(mapped(keyed.where("text IS NOT NULL").select("doc_id", "th", "text"), _hot_windows(units, hot, first_stays), "one long, two long, doc_id long, th long, at long, until long"))
        asks, own = windows.where("until IS NULL").drop("until"), F.struct("doc_id", "th", "at")
        counts = written(asks.groupBy("one", "two").agg(F.min(own).alias("first"), F.count("*").alias("n")).where("n > 1"))
        again = told_by(asks, counts, ["one", "two"])
        if first_stays:
            again = again.where(own > F.col("first"))
        spans = spans.unionAll(again.select("doc_id", "th", F.col("at").alias("a"), (F.col("at") + units.window).alias("b")))
        spans = spans.unionAll(windows.where("until IS NOT NULL").select("doc_id", "th", F.col("at").alias("a"), F.col("until").alias("b")))
    whole = told_by(ids, copies, ["th", "digest"]).where("doc_id > one" if first_stays else "true").select("doc_id", "th", F.lit(0).cast("long").alias("a"), F.lit(WHOLE).alias("b")).distinct()
    return texts, spans.unionAll(whole).groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def removed_items(spans: list[list[dict] | None], sizes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """A boolean per item of a batch: whether a span covers it. A whole text below one window is not covered."""
    step = np.zeros(int(sizes.sum()) + 1, np.int64)
    for row, own in enumerate(spans):
        size = int(sizes[row])
        if own and size >= window:
            base = int(first[row])
            for s in own:
                step[base + s["a"]] += 1
                step[base + min(s["b"], size)] -= 1
    return np.cumsum(step)[:-1] > 0
