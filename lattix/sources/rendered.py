"""Elements from their text rendering: ``label[lab.loc]{map}`` and ``label[id][start,end]{map}``, and lists of them."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattix.functions import ids, props

_ID = r"\[([0-9]+\.[0-9]+)\]"
_GROUP = re.compile(r"\[[0-9]+\.[0-9]+\](?:\[[0-9]+\.[0-9]+,[0-9]+\.[0-9]+\])?(?=\{)")
_EDGE = r"\[([0-9]+\.[0-9]+)\]\[([0-9]+\.[0-9]+),([0-9]+\.[0-9]+)\]"


def _candidates(raw: Column, middle: str) -> Column:
    """Every way to read the text: labels may hold any character, so each group of identities may be the one."""
    count = F.size(F.regexp_extract_all(raw, F.lit("(" + middle + ")"), F.lit(0)))

    def at(n: Column) -> Column:
        # the n-th group of identities: what stands before it is the label, what follows the map
        parts = F.regexp_extract_all(raw, F.lit("(" + middle + ")"), F.lit(0))
        pieces = F.split(raw, middle)
        before = F.slice(pieces, F.lit(1), n)
        own = F.element_at(parts, n)
        label = F.aggregate(F.sequence(F.lit(1), n), F.lit(""), lambda s, k: F.concat(s, F.element_at(before, k), F.when(k < n, F.element_at(parts, k)).otherwise(F.lit(""))))
        return F.struct(label.alias("label"), own.alias("group"), F.substring(raw, F.length(label) + F.length(own) + 1, F.length(raw)).alias("map"))

    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), at)).otherwise(F.array().cast("array<struct<label:string,group:string,map:string>>"))


def _first_good(raw: Column, middle: str) -> Column:
    """The first identity group with a label before it and one complete JSON object after it."""
    return F.get(F.filter(_candidates(raw, middle), lambda c: (c["label"] != "") & props.is_object(c["map"])), F.lit(0))


def _decoded(raws: Column, middle: str, names: list[str]) -> Column:
    """The elements of a list of texts, null for those that are none.

    First the reading that is right for nearly all texts, a map that starts at the first brace; only texts that it fails
    try the others. Each step is a pass of its own over the list, so that nothing is computed twice.
    """
    shape = rf"(?s)^(.+?){middle}$"

    def cut(raw: Column) -> Column:
        head = F.substring_index(raw, "{", 1)
        return F.struct(raw.alias("raw"), head.alias("head"), F.substring(raw, F.length(head) + 1, F.length(raw)).alias("map"))

    def labelled(c: Column) -> Column:
        return F.struct(*_fields(c, "raw", "head", "map"), F.regexp_extract(c["head"], shape, 1).alias("label"))

    def judged(c: Column) -> Column:
        return F.struct(*_fields(c, "raw", "head", "map", "label"), F.coalesce((c["label"] != "") & props.is_object(c["map"]), F.lit(False)).alias("ok"))

    def searched(c: Column) -> Column:
        own = F.struct(c["label"].alias("label"), F.substring(c["head"], F.length(c["label"]) + 1, F.length(c["head"])).alias("group"), c["map"].alias("map"))
        return F.when(c["ok"], own).otherwise(_first_good(c["raw"], middle))

    def numbered(c: Column) -> Column:
        return F.struct(c["label"].alias("label"), F.regexp_extract_all(c["group"], F.lit(r"([0-9.]+)"), F.lit(1)).alias("ids"), c["map"].alias("properties"))

    def chosen(c: Column) -> Column:
        return F.struct(c["label"].alias("label"), *[ids.parse_id(c["ids"][k]).alias(n) for k, n in enumerate(names)], c["properties"].alias("properties"))

    def whole(c: Column) -> Column:
        fit = c["label"].isNotNull() & c["properties"].isNotNull()
        for n in names:
            fit = fit & c[n].isNotNull()
        return F.when(fit, c)

    steps = raws
    for step in (cut, labelled, judged, searched, numbered, chosen, whole):
        steps = F.transform(steps, step)
    return steps


def _fields(c: Column, *names: str) -> list[Column]:
    return [c[n].alias(n) for n in names]


def _split(df: DataFrame, raw: str, middle: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    # a generated column is computed once; a filter upon it is not pushed below it, where it would be computed again
    held = df.select(*df.columns, F.explode(_decoded(F.array(F.col(raw)), middle, names)).alias("__d"))
    return held.where("__d IS NOT NULL").select(*df.columns, "__d.*"), held.where("__d IS NULL").select(df.columns)


def decode_vertices(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(rows with label, id and properties; rows that are no vertex)."""
    return _split(df, raw, _ID, ["id"])


def decode_edges(df: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(rows with label, id, start, end and properties; rows that are no edge)."""
    return _split(df, raw, _EDGE, ["id", "start", "end"])


_DECODER = json.JSONDecoder()


def _element_end(body: str, at: int) -> int:
    """Where the element at ``at`` ends: behind NULL, or behind the first JSON object that closes an element there; -1 if none does.

    The object stands behind an identity group, of which each in turn is tried; what comes before the group is the label,
    of one character at least.
    """
    if body.startswith("NULL", at) and body[at + 4 : at + 5] in ("", ","):
        return at + 4
    group = _GROUP.search(body, at + 1)
    while group:
        try:
            end = _DECODER.raw_decode(body, group.end())[1]
        except (ValueError, RecursionError):
            end = -1
        if end > 0 and body[end : end + 1] in ("", ","):
            return end
        group = _GROUP.search(body, group.start() + 1)
    return -1


def split_elements(text: str | None) -> list[str | None] | None:
    """The elements of ``[a,b,...]``, NULL as None; None if the text is no such list. Labels may hold any character."""
    if text is None or len(text) < 2 or not (text.startswith("[") and text.endswith("]")):
        return None
    body, out, at = text[1:-1], [], 0
    while body:
        end = _element_end(body, at)
        if end < 0:
            return None
        out.append(None if body[at:end] == "NULL" else body[at:end])
        if end == len(body):
            break
        at = end + 1
    return out


def _codes(chars: str) -> np.ndarray:
    out = np.zeros(256, np.bool_)
    out[[ord(c) for c in chars]] = True
    return out


_SPECIAL, _DIGIT = _codes('[]{},"\\'), _codes("0123456789")
#: What stands between a label and its map, digits as one 0: of a vertex, and of an edge.
_HEADS = [np.frombuffer(h, np.uint8) for h in (b"[0.0]", b"[0.0][0.0,0.0]")]


class _Lists:
    """Many rendered lists as one buffer. ``plain`` tells the rows whose labels hold none of ``[]{},"`` or a backslash and whose maps close: there every bracket, comma and quote is what it seems."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self._cut()

    def _since_row(self, change: np.ndarray) -> np.ndarray:
        """Sums of ``change`` up to and with each byte of its row."""
        total = np.concatenate([[0], np.cumsum(change)])
        return total[1:] - np.repeat(total[self.bounds[:-1]], np.diff(self.bounds))

    def _cut(self) -> None:
        data, low, high = self.data, self.bounds[:-1], self.bounds[1:]
        at, is_slash = np.arange(len(data)), data == 92
        other = np.maximum.accumulate(np.where(is_slash, -1, at)) if len(data) else at
        slashes = np.concatenate([[0], (at - other)[:-1]])  # how many stand right before a byte
        quote = (data == 34) & (slashes % 2 == 0)
        quotes = self._since_row(quote)
        outside = ((quotes - quote) % 2 == 0) & ~quote
        opens, closes = outside & (data == 123), outside & (data == 125)
        depth = self._since_row(opens.astype(np.int64) - closes)
        flat = outside & (depth == 0) & ~closes
        lists = self._since_row((flat & (data == 91)).astype(np.int64) - (flat & (data == 93)))
        comma = flat & (data == 44) & (lists == 1)

        fit = high - low >= 2
        ends = np.where(fit, high - 1, 0)
        fit &= (data[np.where(fit, low, 0)] == 91) & (data[ends] == 93) if len(data) else fit
        fit &= (quotes[ends] % 2 == 0) & (depth[ends] == 0) & (lists[ends] == 0) if len(data) else fit
        wrong = np.flatnonzero((depth < 0) | (lists < 1))  # a list closes with its last byte alone
        if len(wrong):
            of = np.searchsorted(self.bounds, wrong, side="right") - 1
            fit[of[wrong != high[of] - 1]] = False

        some = np.flatnonzero(fit & (high - low > 2))
        kept = np.zeros(len(fit), np.bool_)
        kept[some] = True
        cuts = np.flatnonzero(comma)
        row_of_cut = np.searchsorted(self.bounds, cuts, side="right") - 1
        cuts, row_of_cut = cuts[kept[row_of_cut]], row_of_cut[kept[row_of_cut]]
        starts = np.sort(np.concatenate([low[some] + 1, cuts + 1]))
        stops = np.sort(np.concatenate([high[some] - 1, cuts]))
        rows = np.searchsorted(self.bounds, starts, side="right") - 1

        nothing = stops - starts == 4
        for k, c in enumerate(b"NULL"):
            nothing &= data[np.minimum(starts + k, len(data) - 1)] == c if len(data) else nothing
        special, braces, closed = np.flatnonzero(_SPECIAL[data]), np.flatnonzero(opens), np.flatnonzero(closes & (depth == 0))
        after = lambda places, x: np.append(places, len(data))[np.searchsorted(places, x)]
        head, self.map = after(special, starts), after(braces, starts)
        good = (head > starts) & (self.map < stops) & (after(closed, starts) == stops - 1)
        token = ~_DIGIT[data]
        token[1:] |= ~_DIGIT[data[:-1]]
        tokens = np.flatnonzero(token)
        shown = np.append(np.where(_DIGIT[data[tokens]], 48, data[tokens]), np.zeros(16, np.uint8))
        first, n = np.searchsorted(tokens, head), np.searchsorted(tokens, self.map) - np.searchsorted(tokens, head)
        known = np.zeros(len(starts), np.bool_)
        for h in _HEADS:
            known |= (n == len(h)) & (shown[np.minimum(first[:, None] + np.arange(len(h)), len(shown) - 1)] == h).all(1)
        good = nothing | (good & known)
        fit[rows[~good]] = False
        self.plain, self.rows, self.starts, self.stops, self.nothing = fit, rows, starts, stops, nothing


def _element_texts(raw: pa.Array) -> pa.Array:
    """The elements of each list. Plain lists are cut all at once; only the others are read one by one."""
    lists = _Lists(raw)
    text = lists.data.tobytes()
    whole = lists.plain.copy()
    for row, low, high in zip(lists.rows.tolist(), lists.map.tolist(), lists.stops.tolist(), strict=True):
        if high - low > 2 and whole[row]:  # {} needs no look
            try:
                whole[row] = _DECODER.raw_decode(text[low:high].decode())[1] > 0
            except (ValueError, RecursionError):
                whole[row] = False
    kept = whole[lists.rows]
    starts, sizes, nothing = lists.starts[kept], (lists.stops - lists.starts)[kept], lists.nothing[kept]
    sizes = np.where(nothing, 0, sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)
    values = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(lists.data[place].tobytes()), pa.array(~nothing).buffers()[1]).cast(pa.string())
    counts = np.bincount(lists.rows[kept], minlength=len(raw))
    plain = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
    odd = np.flatnonzero(~whole)
    if not len(odd):
        return plain
    read = pa.array([split_elements(x) for x in raw.take(pa.array(odd)).to_pylist()], plain.type)
    at = np.arange(len(raw))
    at[odd] = len(raw) + np.arange(len(odd))
    return pa.concat_arrays([plain, read]).take(pa.array(at))


element_texts = F.arrow_udf(_element_texts, T.ArrayType(T.StringType()))


def decode_paths(df: DataFrame, raw: str = "raw", key: str = "row") -> tuple[DataFrame, DataFrame]:
    """Paths as (key, vertices, edges), and the rows that are none: an even count, an empty slot or a bad element.

    Only the cutting of the text runs in Python, in Arrow batches; the elements are decoded as in the other readers, each
    path in its own row, so nothing is shuffled.
    """
    texts = df.select("*", element_texts(F.col(raw)).alias("__e"))
    even, odd = (F.filter("__e", lambda _, k: k % 2 == 0), F.filter("__e", lambda _, k: k % 2 == 1))
    sized = (F.size("__e") == 0) | (F.size("__e") % 2 == 1)
    read = F.when(F.coalesce(sized & F.col("__e").isNotNull(), F.lit(False)), F.struct(_decoded(even, _ID, ["id"]).alias("v"), _decoded(odd, _EDGE, ["id", "start", "end"]).alias("e")))
    held = texts.select(*df.columns, F.explode(F.array(read)).alias("__d"))
    fit = F.coalesce(F.col("__d").isNotNull() & ~F.exists("__d.v", lambda x: x.isNull()) & ~F.exists("__d.e", lambda x: x.isNull()), F.lit(False))
    ordered = lambda c, *names: F.transform(c, lambda x: F.struct(*_fields(x, *names)))
    good = held.where(fit).select(key, ordered("__d.v", "id", "label", "properties").alias("vertices"), ordered("__d.e", "id", "label", "start", "end", "properties").alias("edges"))
    return good, held.where(~fit).select(df.columns)
