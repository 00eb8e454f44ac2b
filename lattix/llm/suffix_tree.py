"""Language-model scores: a probabilistic suffix tree over words, with a second one that spells rare words, beside a smoothed count of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import LOWER, SPACE, RollingHash, mapped, mixed, pieces, stretches, text_bytes, word_spans, written

#: Words and pairs of words with at least this share of the training tokens are known to every task, at most 1 / HOT of each.
HOT = 1e-5
#: Nats that a context must save on its own occurrences, each foretold by the others, before it is kept.
EVIDENCE = 10.0
#: Words of the longest contexts that are looked for, and how many times the share of ``HOT`` those of two words and more have.
LONGEST, LONGER = 3, 10
#: Weight, in symbols, of a shorter context's distribution in a longer one's.
PRIOR = 8.0
#: Longest context of the tree that spells words, in symbols, and the least share of all symbols that its contexts
#: have: at most DEPTH / SPELLED of them at any size.
DEPTH, SPELLED = 4, 2e-5
#: Bytes of occurrences that one shard should hold.
SHARD_BYTES = 16_000_000

_START, _GAP = 0, 1


def _classes() -> np.ndarray:
    """Bytes to 61 of 64 symbols: letters alone, digits together, common punctuation alone, UTF-8 parts in groups."""
    out = np.full(256, 32, np.uint8)
    out[97:123] = np.arange(3, 29)
    out[48:58] = 29
    out[192:] = 35
    out[0xC3], out[0xC2] = 33, 34
    out[128:192] = 36 + (np.arange(128, 192) & 15)
    for k, marks in enumerate((b"-", b"'", b'"', b"|", b"!", b"?", b":", b";", b"(", b")", b"#*$%&<>", b"=+")):
        out[list(marks)] = 52 + k
    out[ord(".")], out[ord(",")] = 30, 31
    return out


CLASSES = _classes()
#: The hash that stands for a text's end among those of words.
END_HASH = np.int64(0x5EED)


class Tokens:
    """The words of a batch of texts, each text's end after them: hashes and rows of all, bounds of the words in ``data``."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        self.data, n = LOWER[data], len(texts)
        starts, ends, rows = word_spans(data, offsets, SPACE)
        after = np.searchsorted(rows, np.arange(n), side="right")
        self.hashes = np.insert(RollingHash(self.data)(starts, ends).view(np.int64), after, END_HASH)
        self.starts, self.ends = np.insert(starts, after, 0), np.insert(ends, after, 0)
        self.rows = np.insert(rows, after, np.arange(n))
        self.count = np.bincount(self.rows, minlength=n)


class Spelling:
    """Symbols of words and of the gap after each, and for every one the ``DEPTH`` symbols before it in its word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        sizes = ends - starts
        room = sizes + 1 + DEPTH
        after = np.cumsum(room)
        total = int(after[-1]) if len(after) else 0
        self.word_of = np.repeat(np.arange(len(sizes)), room)
        place = np.arange(total) - np.repeat(after - room, room) - DEPTH
        inside = (place >= 0) & (place < sizes[self.word_of])
        self.bytes = np.zeros(total, np.uint8)
        self.bytes[inside] = data[(np.repeat(starts, room) + place)[inside]]
        symbols = np.full(total, _START, np.int32)
        symbols[inside] = CLASSES[self.bytes[inside]]
        symbols[after - 1] = _GAP
        self.context = np.zeros(total, np.int32)
        for k in range(1, DEPTH + 1):
            self.context[k:] += symbols[:-k] << (6 * (k - 1))
        self.symbols, self.real, self.inside = symbols, place >= 0, inside


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes, and so on: high bytes of small numbers lie together and shrink in the shuffle."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _of_planes(blob: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        batch = batch.filter(pa.array(~np.asarray(batch["held_out"].to_numpy(zero_copy_only=False), np.bool_)))
        if batch.num_rows:
            yield batch


class _Held:
    """Counts of several kinds, summed up whenever there are many."""

    def __init__(self):
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, kind: int, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.setdefault(kind, []).append((keys, counts))
        self.size += len(keys)

    def out(self) -> Iterator[pa.RecordBatch]:
        for kind, parts in self.parts.items():
            keys, counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            for a in range(0, len(keys), 200_000):
                k, c = keys[a : a + 200_000], counts[a : a + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(c)], ["kind", "key", "n"])
        self.parts, self.size = {}, 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the training texts of a partition, each with its count."""
    held = _Held()
    for batch in _training(batches):
        held.add(0, *np.unique(Tokens(batch["text"]).hashes, return_counts=True))
        if held.size > 3_000_000:
            yield from held.out()
    yield from held.out()


class SpellingTree:
    """Kept contexts and their next-symbol distributions; a word is spelled in the states of its longest kept suffixes."""

    def __init__(self, kept: list[tuple[int, int, np.ndarray]], byte_counts: np.ndarray):
        """kept: (length, context, counts of the 64 next symbols), the empty context among them, if any was seen."""
        nodes = {(d, c): n.astype(np.float64) for d, c, n in kept}
        total = nodes.get((0, 0), np.zeros(64))
        root = (total + 1) / (total.sum() + 64)
        self.states, shares = [(0, 0)], {(0, 0): root}
        for d, c in sorted(k for k in nodes if k[0]):
            parent = next(shares[k, c & ((1 << 6 * k) - 1)] for k in range(d - 1, -1, -1) if (k, c & ((1 << 6 * k) - 1)) in shares)
            shares[d, c] = (nodes[d, c] + PRIOR * parent) / (nodes[d, c].sum() + PRIOR)
            self.states.append((d, c))
        self.log = np.log10(np.stack([shares[s] for s in self.states])).astype(np.float32)
        own = byte_counts + 1.0
        within = np.bincount(CLASSES, own, 64)
        self.byte_log = np.log10(own / within[CLASSES])
        self._table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def table(self) -> np.ndarray:
        """The state of every context of full length; longer suffixes overwrite shorter ones."""
        if self._table is None:
            out = np.zeros(1 << 6 * DEPTH, np.int32)
            for k, (d, c) in enumerate(self.states):
                if d:
                    out.reshape(-1, 1 << 6 * d)[:, c] = k
            self._table = out
        return self._table

    def spell(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of the share of each word among all spellings."""
        if not len(starts):
            return np.zeros(0)
        x = Spelling(data, starts, ends)
        real = x.real
        each = self.log[self.table()[x.context[real]], x.symbols[real]] + np.where(x.inside[real], self.byte_log[x.bytes[real]], 0.0)
        return np.bincount(x.word_of[real], each, len(starts))


def _saved(prior: float) -> str:
    """Nats that n occurrences of a symbol save if each is foretold by the others of its context, against the share q."""
    return f"n * (ln((n - 1 + {prior} * q) / (`all` - 1 + {prior})) - ln(q))"


def _fit_spelling(counts: DataFrame) -> SpellingTree:
    """Divergence tests over the counted runs; only contexts that pass and have their share of all symbols reach the driver."""
    runs = counts.where("kind = 1").selectExpr("shiftright(key, 6) AS full", "cast(key & 63 AS int) AS sym", "n")
    total = runs.agg(F.sum("n")).first()[0]
    byte_counts = np.zeros(256)
    for r in counts.where("kind = 2").collect():  # at most 256
        byte_counts[r["key"]] = r["n"]
    if not total:
        return SpellingTree([], byte_counts)
    listed = F.collect_list(F.struct("sym", "n")).alias("next")
    level = written(runs.groupBy(F.col("full").alias("ctx"), "sym").agg(F.sum("n").alias("n")))
    kept = []
    for d in range(DEPTH, -1, -1):  # each length is summed from the next longer one
        shorter = written(level.groupBy(F.expr(f"ctx & {(1 << 6 * (d - 1)) - 1}L").alias("ctx"), "sym").agg(F.sum("n").alias("n"))) if d else None
        each = level.groupBy("ctx").agg(F.sum("n").alias("all"), listed).where(F.col("all") >= SPELLED * total)
        if d:
            parent = shorter.join(shorter.groupBy("ctx").agg(F.sum("n").alias("above")), "ctx").selectExpr("ctx AS up", "sym", "n / above AS q")
            child = each.select("ctx", "all", F.explode("next").alias("x")).select("ctx", "all", "x.*").withColumn("up", F.expr(f"ctx & {(1 << 6 * (d - 1)) - 1}L"))
            good = child.join(parent, ["up", "sym"]).groupBy("ctx").agg(F.sum(F.expr(_saved(PRIOR))).alias("saved")).where(F.col("saved") >= EVIDENCE)
            each = each.join(good, "ctx", "left_semi")
        for r in each.collect():  # at most 1 / SPELLED
            n = np.zeros(64)
            n[[x["sym"] for x in r["next"]]] = [x["n"] for x in r["next"]]
            kept.append((d, r["ctx"], n))
        level = shorter
    return SpellingTree(kept, byte_counts)


def _found(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands among the sorted known ones, -1 for those that aren't among them."""
    if not len(known):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def _pair(before: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return before << 24 | symbol


class Level:
    """Contexts of one length by number: their counts, 0 for those that aren't kept, and their frequent next words.

    ``keys`` tell a context of more than one word by the number of the context of its older words and by its last word;
    ``parent`` is the number of the context without its oldest word.
    """

    def __init__(self, n: int, keys: np.ndarray | None = None, parent: np.ndarray | None = None):
        self.keys, self.parent = keys, parent
        self.count, self.left = np.zeros(n), np.zeros(n)
        self.pairs, self.pair_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def keep(self, kept: list[tuple[int, int]], often: list[tuple[int, int]]) -> None:
        """(context, count) of the kept ones, and (pair, count) of frequent next words, of which those of kept contexts are told."""
        for context, n in kept:
            self.count[context] = n
        found = sorted(x for x in often if self.count[x[0] >> 24] > 0)
        self.pairs, self.pair_counts = np.array([k for k, _ in found], np.int64), np.array([n for _, n in found], np.int64)
        told = np.bincount(self.pairs >> 24, self.pair_counts, len(self.count)) if len(found) else 0.0
        self.left = self.count - told + PRIOR


class WordModel:
    """What every task knows: the frequent words, the contexts that were kept, their frequent next words, and how to spell.

    Symbols are the frequent words by number, then one for all rare words, and, as a context alone, a text's start.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: int, types: int):
        self.words, self.counts, self.spelling = words, counts, SpellingTree([], np.zeros(256))
        self.rare, self.start = len(words), len(words) + 1
        self.rare_tokens, self.rare_weight = tokens - int(counts.sum()), max(1, types - len(words))
        self.share = (np.append(counts, self.rare_tokens) + 1.0) / (tokens + len(words) + 1)
        self.levels = [Level(len(words) + 2)]

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = _found(self.words, hashes)
        return np.where(at >= 0, at, self.rare)

    def contexts(self, symbols: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        """Of each length the number of the context before every symbol, -1 for one that is no candidate. A text's start is the oldest word of any."""
        first = np.cumsum(count) - count
        own = np.empty_like(symbols)
        own[1:] = symbols[:-1]
        own[first] = self.start
        out = [own]
        for level in self.levels[1:]:
            key = np.empty_like(symbols)
            key[1:] = np.where(out[-1][:-1] >= 0, _pair(out[-1][:-1], symbols[:-1]), -1)
            key[first] = -1
            out.append(_found(level.keys, key))
        return out

    def share_after(self, length: int, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The share of each symbol after contexts of a length, as far as every task knows it; that of all symbols is one.

        What a kept context's frequent next words leave of its count is shared out as after the next shorter context.
        """
        if not length:
            return self.share[symbol]
        level = self.levels[length - 1]
        lower = self.share_after(length - 1, context if length == 1 else level.parent[context], symbol)
        n, at = level.count[context], _found(level.pairs, _pair(context, symbol))
        often = np.where(at >= 0, level.pair_counts[at], 0) if len(level.pairs) else 0
        return np.where(n > 0, (often + level.left[context] * lower) / (n + PRIOR), lower)


def _fit_words(texts: DataFrame, counts: DataFrame, tokens: int, types: int) -> WordModel:
    """A pass over the training texts for each length of contexts counts the symbols after them; the first also how rare words are spelled.

    The tables of counts grow with the corpus and stay tables. Contexts of one word more are looked for where those of
    one word less are very frequent with their next word. Each is kept on its own evidence: if its occurrences, each foretold
    by the others, save ``EVIDENCE`` nats against the next shorter context.
    """
    spark = texts.sparkSession
    found = counts.where(f"kind = 0 AND n >= {HOT} * {tokens}").select("key", "n").collect() if tokens else []  # at most 1 / HOT
    found.sort()
    model = WordModel(np.array([r["key"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64), tokens, types)
    if not tokens:
        return model
    for length in range(1, LONGEST + 1):
        known = spark.sparkContext.broadcast(model)

        def counted(batches: Iterator[pa.RecordBatch], length: int = length, known: object = known) -> Iterator[pa.RecordBatch]:
            held, own = _Held(), known.value
            for batch in _training(batches):
                x = Tokens(batch["text"])
                s = own.symbols(x.hashes)
                context = own.contexts(s, x.count)[length - 1]
                some = context >= 0
                held.add(0, *np.unique(_pair(context[some], s[some]), return_counts=True))
                if length == 1:
                    rare = s == own.rare
                    _, at, n = np.unique(x.hashes[rare], return_index=True, return_counts=True)
                    told = Spelling(x.data, x.starts[rare][at], x.ends[rare][at])
                    times = n[told.word_of]
                    held.add(1, *_summed((told.context.astype(np.int64) << 6 | told.symbols)[told.real], times[told.real]))
                    seen = np.bincount(told.bytes[told.inside], times[told.inside], 256).astype(np.int64)
                    held.add(2, np.flatnonzero(seen), seen[seen > 0])
                if held.size > 3_000_000:
                    yield from held.out()
            yield from held.out()

        def foretold(batches: Iterator[pa.RecordBatch], length: int = length, known: object = known) -> Iterator[pa.RecordBatch]:
            own = known.value
            for batch in batches:
                key = batch["key"].to_numpy()
                context, symbol = key >> 24, key & 0xFFFFFF
                q = own.share_after(length - 1, context if length == 1 else own.levels[-1].parent[context], symbol)
                yield pa.RecordBatch.from_arrays([pa.array(context), batch["n"], pa.array(q)], ["ctx", "n", "q"])

        told = written(mapped(texts, counted, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
        if length == 1:
            model.spelling = _fit_spelling(told)
        pairs = told.where("kind = 0").select("key", "n")
        each = mapped(pairs, foretold, "ctx long, n long, q double")
        # the sum of ``_saved`` over a context's next words, its own count taken out of the sum, so that a context's rows are combined before the shuffle
        sums = each.groupBy("ctx").agg(F.sum("n").alias("all"), F.sum(F.expr(f"n * (ln(n - 1 + {PRIOR} * q) - ln(q))")).alias("told"))
        saved = sums.withColumn("saved", F.expr(f"told - `all` * ln(`all` - 1 + {PRIOR})")).where(F.col("saved") >= EVIDENCE)
        often = [(r["key"], r["n"]) for r in pairs.where(f"n >= {max(2.0, HOT * tokens)}").collect()]  # at most 1 / HOT
        level = model.levels[-1]
        level.keep([(r["ctx"], r["all"]) for r in saved.collect()], often)  # contexts of one word are as many as symbols, longer ones at most 1 / (LONGER * HOT)
        keys = np.array(sorted(k for k, n in often if n >= LONGER * HOT * tokens), np.int64)
        if not len(keys) or length == LONGEST:
            break
        older, last = keys >> 24, keys & 0xFFFFFF
        parent = last if length == 1 else _found(level.keys, _pair(level.parent[older], last))
        some = parent >= 0
        model.levels.append(Level(int(some.sum()), keys[some], parent[some]))
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the text's words and its end. Each word is foretold in the state of its
    longest kept context, of up to ``LONGEST`` words, smoothed by the next shorter one. A rare word is foretold as such,
    then by its count among rare words, smoothed by the tree that spells it.

    Passes over all training texts count words, then the words after contexts of each length and symbol runs of rare words, combined per task before the
    shuffles. Words, and contexts with a next word, of at least a share of ``HOT`` are few by that bound and go to every task; all
    occurrences of every other word, or context with its next word, meet in a shard of their own hash, where the training ones are its
    count, and each shard returns the sums of the texts of a piece in one row. So no word, however frequent, gathers
    its texts in one task. Words and pairs are told apart by 64-bit hashes. Null and empty texts are an end alone; very long texts are scored whole;
    repeated rows and rows without an id are scored each; other columns are not read; an empty table gives none;
    without training texts every count is 0. Nothing is chosen among ties.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    counts = written(mapped(texts.select("text", "held_out"), _counts, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    size = counts.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = size["tokens"], size["types"]
    sent = spark.sparkContext.broadcast(_fit_words(texts.select("text", "held_out"), counts, tokens, types))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens * 21 // SHARD_BYTES))
    prior = PRIOR

    kind = docs.schema[id_col].dataType.simpleString()
    lists = {"doc_id": kind, "held_out": "boolean", "n_tokens": "bigint", "known": "bigint", "logs": "double", "score": "double"}
    blobs = {"hashes": np.int64, "rows": np.int32, "kinds": np.uint8, "adds": np.float32}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each piece of text one row with what is known of its texts, and a row to each shard that has words or pairs of it.

        An occurrence is worth log10(count + 10 ** add); its kind is 1 for training, 2 more for a context with its next
        word, and 4 more for one that is counted but foretold in a longer context.
        """
        model = sent.value
        for batch in pieces(batches, "text"):
            x, n = Tokens(batch["text"]), batch.num_rows
            piece = batch["row"][0].as_py()
            train = (~np.asarray(batch["held_out"].to_numpy(zero_copy_only=False), np.bool_)).astype(np.uint8)
            s = model.symbols(x.hashes)
            hot = s < model.rare
            known = np.bincount(x.rows[hot], minlength=n)
            logs = np.bincount(x.rows[hot], np.log10(model.counts[s[hot]] + 1.0) if len(model.counts) else None, n).astype(np.float64)
            each = np.log10(model.share[s])
            longer = np.zeros(len(s), np.bool_)  # who is foretold in a longer context is counted in the shorter ones alone
            sent_on = []
            for length, ctx in reversed(list(enumerate(model.contexts(s, x.count), 1))):
                level = model.levels[length - 1]
                seen = np.where(ctx >= 0, level.count[ctx], 0)
                at = np.flatnonzero(seen > 0)
                key = _pair(ctx[at], s[at])
                add = prior * model.share_after(length - 1, ctx[at] if length == 1 else level.parent[ctx[at]], s[at])
                often = _found(level.pairs, key)
                new = ~longer[at]
                each[at[new]] = -np.log10(seen[at[new]] + prior)
                told = new & (often >= 0)
                each[at[told]] += np.log10(level.pair_counts[often[told]] + add[told]) if len(level.pairs) else 0.0
                rest = np.flatnonzero((often < 0) & (new | (train[x.rows[at]] > 0)))
                sent_on.append((mixed(key[rest].astype(np.uint64) + np.uint64(length << 60)).view(np.int64), x.rows[at[rest]], np.where(new[rest], 2, 6).astype(np.uint8), np.log10(add[rest])))
                longer[at] = True
            each[~hot] -= np.log10(model.rare_tokens + model.rare_weight)
            score = np.bincount(x.rows, each, n)

            words, first, of = np.unique(x.hashes[~hot], return_index=True, return_inverse=True)
            spelled = model.spelling.spell(x.data, x.starts[~hot][first], x.ends[~hot][first])
            keys, of_rows, of_kinds, of_adds = (np.concatenate(c) for c in zip(*sent_on, strict=True))
            rest = np.concatenate([x.hashes[~hot], keys])
            rows = np.concatenate([x.rows[~hot], of_rows]).astype(np.int32)
            kinds = train[rows] + np.concatenate([np.zeros(int((~hot).sum()), np.uint8), of_kinds])
            adds = np.concatenate([np.log10(model.rare_weight) + spelled[of], of_adds]).astype(np.float32)
            counted = kinds >= 4  # in training texts alone; of these the count is all that is read
            rows[counted], adds[counted] = 0, 0.0
            to = (rest.view(np.uint64) >> np.uint64(32)).astype(np.int64) % shards
            order = np.lexsort((counted, to))
            packed = dict(zip(blobs, (rest[order], rows[order], kinds[order], adds[order]), strict=True))
            to = to[order]
            spans = stretches(to)
            m = len(spans)
            told = {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "n_tokens": pa.array(x.count), "known": pa.array(known), "logs": pa.array(logs), "score": pa.array(score)}
            one = [0] + [n] * (m + 1)  # the first row has the lists, the others none
            valid = pa.array([False] + [True] * m)
            columns = {"shard": pa.array(np.array([piece % shards, *(to[a] for a, _ in spans)], np.int32)), "piece": pa.array(np.full(m + 1, piece, np.int64))}
            for name, values in told.items():
                columns[name] = pa.ListArray.from_arrays(pa.array(one, pa.int32()), values, mask=valid)
            for name, values in packed.items():
                columns[name] = pa.array([None] + [_planes(values[a:b]) for a, b in spans], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In each shard: the count of every word and pair over all pieces, then for each piece sums over its texts."""
        shard, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, _, k, a = (np.concatenate([_of_planes(p[i], d) for p in held]) for i, d in enumerate(blobs.values(), 1))
            found, of = np.unique(h, return_inverse=True)
            c = np.bincount(of, k & 1, len(found))[of]
            word = k < 2
            seen, value, score = (c > 0) & word, np.where(word, np.log10(c + 1), 0.0), a.astype(np.float64)
            score[c > 0] = np.log10(c[c > 0] + 10.0 ** score[c > 0])
            score[k >= 4] = 0.0
            rows, at = [], 0
            for piece, _, r, _, _ in held:
                local = _of_planes(r, np.int32)
                which, index = np.unique(local, return_inverse=True)
                mine = slice(at, at + len(local))
                at += len(local)
                rows.append((piece, _planes(which), _planes(np.bincount(index, seen[mine], len(which)).astype(np.int32)), *(_planes(np.bincount(index, x[mine], len(which))) for x in (value, score))))
            held.clear()
            m = len(rows)
            columns = {"piece": pa.array([r[0] for r in rows], pa.int64())} | {n: pa.nulls(m, types[n]) for n in lists}
            columns |= {n: pa.array([r[k] for r in rows], pa.binary()) for k, n in enumerate(("rows", "more_known", "more_logs", "more_score"), 1)}
            yield pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            types = {n: batch.schema.field(n).type for n in lists}
            whole = batch.filter(batch["rows"].is_null())
            if whole.num_rows:
                empty = pa.nulls(whole.num_rows, pa.binary())
                yield pa.RecordBatch.from_pydict({"piece": whole["piece"]} | {n: whole[n] for n in lists} | {"rows": empty, "more_known": empty, "more_logs": empty, "more_score": empty})
            packed = batch.filter(batch["rows"].is_valid())
            for s, *part in zip(packed["shard"].to_pylist(), *(packed[c].to_pylist() for c in ("piece", *blobs)), strict=True):
                if s != shard:
                    yield from out()
                    shard = s
                held.append(part)
        yield from out()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of each piece's texts, from its own row and all shards."""
        piece, own, more = None, None, []

        def out() -> Iterator[pa.RecordBatch]:
            if own is None:
                return
            known, logs, score = (own[n].flatten().to_numpy().copy() for n in ("known", "logs", "score"))
            for rows, k, v, w in more:
                at = _of_planes(rows, np.int32)
                known[at] += _of_planes(k, np.int32)
                logs[at] += _of_planes(v, np.float64)
                score[at] += _of_planes(w, np.float64)
            yield pa.RecordBatch.from_pydict({n: own[n].flatten() for n in ("doc_id", "held_out", "n_tokens")} | {"n_known": pa.array(known), "logs": pa.array(logs), "score": pa.array(score)})

        for batch in batches:
            for k, (at, rows, *sums) in enumerate(zip(*(batch[c].to_pylist() for c in ("piece", "rows", "more_known", "more_logs", "more_score")), strict=True)):
                if at != piece:
                    yield from out()
                    piece, own, more = at, None, []
                if rows is None:
                    own = batch.slice(k, 1)
                else:
                    more.append((rows, *sums))
        yield from out()

    arrays = ", ".join(f"{n} array<{t}>" for n, t in lists.items())
    sharded = mapped(texts.withColumn("row", F.monotonically_increasing_id()), dealt, f"shard int, piece long, {arrays}, {', '.join(f'{n} binary' for n in blobs)}")
    sums = mapped(sharded.repartition(shards, "shard").sortWithinPartitions("shard"), summed, f"piece long, {arrays}, rows binary, more_known binary, more_logs binary, more_score binary")
    each = mapped(sums.repartition(shards, "piece").sortWithinPartitions("piece"), joined, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, score double")
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(tokens + types + 1)))
    return each.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
