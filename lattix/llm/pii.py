"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans."""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattix.llm.batches import SPACE, mapped, pieces, text_bytes, word_spans

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
#: The model is fitted on the documents with the smallest hashes of their ids, this many, and on so many word runs at most.
TRAIN_DOCS, TRAIN_RUNS, EPOCHS, RATE, DECAY = 2_000, 1_500, 6, 0.3, 1e-5
#: Words that one entity may have.
MOST_WORDS = 6
#: Invented cards, and tokens, that are written out in several ways as further training runs.
VARIED = 24
#: How much likelier than any other reading an added span must be.
MARGIN = 2.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four fixed patterns in code points, per kind from left to right, none overlapping its own kind."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    if "." in text:
        for run in _DOTTED.finditer(text):
            if run.group().count(".") < 3:
                continue
            parts, at = run.group().split("."), run.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                    out.append(("ip", at, at + size))
                at += size + 1
    for m in _GROUPED.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def _log_sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b)) of single numbers."""
    a, b = (a, b) if a > b else (b, a)
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


_EDGE = "\"'`([{<>}]),;:!?.|=*_"


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """Without punctuation at the edges."""
    while start < end and text[start] in _EDGE and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    while end > start and text[end - 1] in _EDGE:
        end -= 1
    return start, end


def span_features(span: str, words: int) -> list[str]:
    """What is known of a whole candidate: its make-up, never its exact characters."""
    digits = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    others = "".join(sorted({c for c in span if not c.isalnum()}))
    groups = re.findall(r"[0-9]+", span)
    low = span.lower()
    out = [f"words={words}", f"digits={min(digits, 20)}", f"letters={min(letters, 4) if letters < 20 else 20}", f"marks={others[:8]}", f"groups={min(len(groups), 6)}", f"open={span[:1] if span[:1] in '+(' else ''}"]
    if letters == 0 and 13 <= digits <= 19:
        out.append(f"luhn={luhn(''.join(groups))}")
        out.append(f"sizes={','.join(str(len(g)) for g in groups[:6])}")
    if len(groups) == 4 and others == "." and letters == 0:
        out.append(f"quad={all(len(g) < 4 and int(g) < 256 for g in groups)}")
    if "@" in span:
        out.append(f"mail={bool(re.fullmatch(r'[^@ ]+@[^@ ]+[.][^@ .]+', span))}")
    if len(span) >= 16 and words == 1:
        out.append(f"hex={len(span) >= 32 and digits > 3 and letters > 3 and all(c in '0123456789abcdef' for c in low)}")
        out.append(f"token={len(span) >= 20 and digits > 3 and letters > 3 and span.isascii() and span.isalnum() and len(groups) > 3}")
    return out


class SemiMarkov:
    """Scores of (label, feature) and of label after label; runs of words are cut into labelled segments.

    A segment without a label has one word; a labelled one has up to ``MOST_WORDS``. Dynamic programming over the end
    of the last segment and its label chooses cuts and labels together.
    """

    LABELS = ("", *KINDS)

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def features(self, text: str, run: list[tuple[int, int]]) -> Callable[[int, int], list[str]]:
        """The features of words i to j of a run, made when asked for: a run may be as long as its text."""

        def of(i: int, j: int) -> list[str]:
            a, b = _core(text, run[i][0], run[j - 1][1])
            return span_features(text[a:b], j - i)

        return of

    def lattice(self, text: str, run: list[tuple[int, int]]) -> dict[tuple[int, int], list[str]]:
        of, n = self.features(text, run), len(run)
        return {(i, j): of(i, j) for i in range(n) for j in range(i + 1, min(n, i + MOST_WORDS) + 1)}

    def score(self, label: str, features: list[str]) -> float:
        get = self.weights.get
        return sum(get((label, f), 0.0) for f in features)

    def step(self, before: str, label: str) -> float:
        return self.weights.get((f">{before}", label), 0.0)

    def segments(self, n: int) -> Iterator[tuple[int, int, str]]:
        for j in range(1, n + 1):
            for i in range(max(0, j - MOST_WORDS), j):
                for label in self.LABELS:
                    if label or j - i == 1:
                        yield i, j, label

    def best(self, features: Callable[[int, int], list[str]], n: int) -> list[tuple[int, int, str]]:
        top: list[dict[str, tuple[float, tuple | None]]] = [{"": (0.0, None)}] + [{} for _ in range(n)]
        at, known = None, []
        for i, j, label in self.segments(n):
            if top[i]:
                if at != (i, j):
                    at, known = (i, j), features(i, j)
                own = self.score(label, known)
                found = max((v + self.step(b, label) + own, b) for b, (v, _) in top[i].items())
                if label not in top[j] or found[0] > top[j][label][0]:
                    top[j][label] = found[0], (i, found[1])
        out, j = [], n
        label = max(top[n], key=lambda k: top[n][k][0])
        while j:
            i, before = top[j][label][1]
            out.append((i, j, label))
            j, label = i, before
        return out[::-1]

    def learn(self, lattice: dict, n: int, told: list[tuple[int, int, str]], rate: float) -> None:
        """A step up the likelihood: features of the told cuts less their expectation under all cuts."""
        own = {s: self.score(s[2], lattice[s[0], s[1]]) for s in self.segments(n)}
        ahead = [dict.fromkeys(self.LABELS, -math.inf) for _ in range(n + 1)]
        ahead[0][""] = 0.0
        for i, j, label in own:
            for before in self.LABELS:
                if ahead[i][before] > -math.inf:
                    ahead[j][label] = _log_sum(ahead[j][label], ahead[i][before] + self.step(before, label) + own[i, j, label])
        behind = [dict.fromkeys(self.LABELS, -math.inf) for _ in range(n)] + [dict.fromkeys(self.LABELS, 0.0)]
        for i, j, label in reversed(own):
            for before in self.LABELS:
                behind[i][before] = _log_sum(behind[i][before], self.step(before, label) + own[i, j, label] + behind[j][label])
        total, change = behind[0][""], defaultdict(float)
        for i, j, label in own:
            for before in self.LABELS:
                if ahead[i][before] > -math.inf:
                    p = math.exp(min(0.0, ahead[i][before] + self.step(before, label) + own[i, j, label] + behind[j][label] - total))
                    if p > 1e-4:
                        change[f">{before}", label] -= p
                        for f in lattice[i, j]:
                            change[label, f] -= p
        before = ""
        for i, j, label in told:
            change[f">{before}", label] += 1
            for f in lattice[i, j]:
                change[label, f] += 1
            before = label
        for key, by in change.items():
            self.weights[key] = self.weights.get(key, 0.0) * (1 - DECAY) + rate * by


def word_runs(texts: pa.Array) -> dict[int, list[list[tuple[int, int]]]]:
    """Per row, runs of neighbouring words that hold a digit or an at sign, in code points of the text."""
    data, offsets = text_bytes(texts)
    telling = np.zeros(256, np.bool_)
    telling[[*range(48, 58), 64]] = True
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(telling[data], out=seen[1:])
    starts, ends, rows = word_spans(data, offsets, SPACE)
    good = seen[ends] > seen[starts]
    starts, ends, rows = starts[good], ends[good], rows[good]
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    base = points[offsets[rows]]
    out: dict[int, list[list[tuple[int, int]]]] = defaultdict(list)
    last, last_row = -2, -1
    for row, at, end, a, b in zip(rows.tolist(), starts.tolist(), ends.tolist(), (points[starts] - base).tolist(), (points[ends] - base).tolist(), strict=True):
        runs = out[row]
        if row == last_row and at == last + 1:
            runs[-1].append((a, b))
        else:
            runs.append([(a, b)])
        last, last_row = end, row
    return out


def told_cuts(text: str, run: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[tuple[int, int, str]] | None:
    """The cuts of a run that the patterns tell; a long word in which letters and digits alternate is told to be a secret."""
    label_of = {}
    for kind, a, b in base:
        inside = [k for k, (s, e) in enumerate(run) if s < b and e > a]
        if inside and len(inside) <= MOST_WORDS and _core(text, run[inside[0]][0], run[inside[-1]][1]) == (a, b):
            label_of[inside[0]] = (inside[-1] + 1, kind)
    out, k = [], 0
    while k < len(run):
        end, kind = label_of.get(k, (k + 1, ""))
        if not kind:
            a, b = _core(text, *run[k])
            kind = "secret" if {"hex=True", "token=True"} & set(span_features(text[a:b], 1)) else ""
        out.append((k, end, kind))
        k = end
    return out


def varied() -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Further training runs, with their cuts: what no fixed pattern tells.

    Cards in groups of four, side by side in each way of writing, and behind a word that ends in a digit; tokens of
    letters and digits, and words and numbers like them that are none. Nothing here depends on chance.
    """
    rng, out = random.Random(20), []
    bodies = ["".join(rng.choices("0123456789", k=15)) for _ in range(VARIED)]
    cards = [b + next(d for d in "0123456789" if luhn(b + d)) for b in bodies]
    ways = [lambda c: [c], lambda c: ["-".join(c[k : k + 4] for k in range(0, len(c), 4))], lambda c: [c[k : k + 4] for k in range(0, len(c), 4)]]
    for k in range(VARIED):
        first, second = cards[k], cards[(k + 1) % len(cards)]
        broken = first[:-1] + str((int(first[-1]) + 1 + k % 8) % 10)
        for way in ways:
            for words in ([(way(first), "card")], [(way(first), "card"), (way(second), "card")], [([f"x{k % 10}"], ""), (way(first), "card")], [([str(1900 + k)], ""), (way(first), "card")], [(way(broken), "")]):
                run: list[str] = []
                cuts: list[tuple[int, int, str]] = []
                for own, kind in words:
                    n = len(run)
                    cuts += [(n, n + len(own), kind)] if kind else [(n + j, n + j + 1, "") for j in range(len(own))]
                    run += own
                out.append((" ".join(run), cuts))
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for k in range(VARIED):
        token = "".join(rng.choices(alphabet if k % 2 else alphabet[:26] + alphabet[52:], k=20 + k % 30))
        kind = "secret" if "token=True" in span_features(token, 1) else ""
        out.append((token, [(0, 1, kind)]))
        out.append(("".join(rng.choices(alphabet[26:52], k=18 + k % 20)) + str(k), [(0, 1, "")]))
        out.append((str(rng.randrange(10 ** (6 + k % 8))), [(0, 1, "")]))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SemiMarkov:
    """A model fitted on word runs of at most ``TRAIN_DOCS`` documents, and on ``varied`` ones; only their short runs reach the driver."""
    hashed = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("i")).where("text IS NOT NULL")
    share = min(1.0, 2 * TRAIN_DOCS / max(1, docs.count()))  # a first cut by hash, so that tasks don't each offer as many
    some = hashed.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("h", "i").limit(TRAIN_DOCS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = []
            for row, runs in word_runs(batch["text"]).items():
                text = batch["text"][row].as_py()
                base = base_spans(text)
                for run in runs:
                    a, b = run[0][0], run[-1][1]
                    if b - a <= 400:
                        spans = [f"{k}:{s - a}:{e - a}" for k, s, e in base if s >= a and e <= b]
                        found.append((text[a:b], ",".join(spans)))
            yield pa.RecordBatch.from_pydict({"run": pa.array([x for x, _ in found], pa.string()), "spans": pa.array([x for _, x in found], pa.string())})

    rows = mapped(some.select("text"), cut, "run string, spans string").distinct().orderBy(F.xxhash64("run"), "spans").limit(TRAIN_RUNS).collect()
    model = SemiMarkov()
    ready = []
    for r in rows:
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", r["run"])]
        base = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        if 0 < len(words) <= 12:
            ready.append((model.lattice(r["run"], words), len(words), told_cuts(r["run"], words, base)))
    for run, told in varied():
        words = [m.span() for m in re.finditer(r"\S+", run)]
        ready.append((model.lattice(run, words), len(words), told))
    for epoch in range(EPOCHS):
        for lattice, n, told in ready:
            model.learn(lattice, n, told, RATE / (1 + epoch))
    return model


def find_spans(text: str, runs: list[list[tuple[int, int]]], model: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the patterns, and spans that the model adds; those touch none of the former."""
    base = base_spans(text)
    starts, ends = [], []  # what the patterns take, joined where it overlaps
    for a, b in sorted((a, b) for _, a, b in base):
        if starts and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def is_free(a: int, b: int) -> bool:
        k = bisect.bisect_right(ends, a)
        return k == len(starts) or starts[k] >= b

    added = []
    for run in runs:
        if starts and not any(is_free(a, b) for a, b in run):
            continue
        features = model.features(text, run)
        for i, j, label in model.best(features, len(run)):
            if label and model.score(label, features(i, j)) > MARGIN + sum(model.score("", features(k, k + 1)) for k in range(i, j)):
                a, b = _core(text, run[i][0], run[j - 1][1])
                if a < b and is_free(a, b):
                    added.append((label, a, b))
    return base, added


def find_personal_data(docs: DataFrame, model: SemiMarkov | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_spans, the number of those.

    Whole texts, each row alone and without a shuffle; null and empty texts have no spans, repeated rows and rows
    without an id are searched each, other columns are not read; an empty table gives none. Of base spans that overlap all stay. The model is a few hundred weights, fitted on a bounded sample.
    """
    model = model or fit(docs, id_col, text_col)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            runs, texts = word_runs(batch["text"]), batch["text"].fill_null("").to_pylist()
            both = [find_spans(t, runs.get(k, []), model) for k, t in enumerate(texts)]
            counts = {f"n_{kind}": pa.array([sum(s[0] == kind for s in base) for base, _ in both], pa.int64()) for kind in BASE_KINDS}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], **counts, "base_sha256": pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in both]), "spans": pa.array([_joined(base + more) for base, more in both]), "n_spans": pa.array([len(base) + len(more) for base, more in both], pa.int64())})

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), found, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or spans that overlap, replaced by the name of the first."""
    out, at = [], 0
    end = -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"[{kind.upper()}]"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, model: SemiMarkov | None = None, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents with all spans masked; ``length_col``, if given, becomes the new length.

    Each row is masked by itself, whatever its id, repeated or none; null texts and their lengths are null, empty ones
    stay; an empty table gives none; of spans that overlap the first names the mask. Other columns stay, whatever their names.
    """
    model = model or fit(docs, id_col, text_col)
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            runs = word_runs(batch[text_col])
            texts = [t if t is None else masked(t, sum(find_spans(t, runs.get(k, []), model), [])) for k, t in enumerate(batch[text_col].to_pylist())]
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array(texts, batch[text_col].type)
            if length_col:
                columns[names.index(length_col)] = pa.array([None if t is None else len(t) for t in texts], batch[length_col].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return mapped(docs, cleaned, docs.schema)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
