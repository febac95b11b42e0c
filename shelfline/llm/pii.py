"""Personal data: base patterns, and boosted trees that choose among proposed spans.

Base spans (email, ip, card, phone) are leftmost, non-overlapping matches of fixed patterns with checks;
they always stay. Generators with high recall propose further spans of each kind, which may overlap: whatever
surrounds an at sign, spelt-out addresses, bracketed dots, and every run of digits and their usual separators. Gradient
boosted trees score a proposal by its format and its context. No spans are labelled, so examples are made
from base spans: copies in their own context, written in ways that no base pattern matches (`(at)`, `[.]`, other
separators, no plus), are right; copies with a fault (a broken Luhn sum, a part above 255, too few digits, a host
without a dot) and proposals of the texts that touch no base span are wrong.

A quarter of the strings, picked by hash, is never fitted. Their examples in all rows, base spans left out,
calibrate a threshold for each kind: the lowest score above which `PRECISION` of at least `LEAST_FOUND` are
right. Without such a score a kind gets nothing added. As true spans that no base pattern matches count as wrong in
it, precision on real text is at least that stated if people respell data as the copies do.

The trees are fitted to about `TRAINING_DOCS` rows, picked by a hash of id and text; that bound is a
parameter. Thresholds come from counts by kind and score, in steps of 1 / `SCORE_STEPS`, over the whole table.
Every whole text is searched.

Defined cases: a null text is empty. Repeated rows are searched one by one. Without base spans nothing is added. Of
overlapping proposals the one with the highest score is taken, of equal scores the first by start, kind and end. An
empty table gives an empty result, and one of base spans only has no threshold. Very long texts are searched whole,
512 rows at a time. Offsets count code points, ends are exclusive. Other columns
are carried or ignored; redaction keeps all columns and brings a column `n_chars` up to date.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.arrays import fresh
from shelfline.session import materialize

KINDS = ["email", "ip", "card", "phone"]
TRAINING_DOCS = 20_000
PRECISION = 0.98
LEAST_FOUND = 20
SCORE_STEPS = 1 << 16
TREES, DEPTH = 16, 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can't start inside a run of digits, so the look-behind only saves trying.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base matches, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# Proposals -------------------------------------------------------------------------------------

_AT = re.compile(r"[^\s@,;<>()\[\]\"']{1,64}@[^\s@,;<>()\[\]\"']{1,255}")
_SPELT = re.compile(r"[\w.%+-]{1,64} ?[\[(]at[\])] ?[\w-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]{1,63}){1,5}", re.I)
_BRACKETED = re.compile(r"[0-9]{1,3}(?: ?[\[(](?:\.|dot)[\])] ?[0-9]{1,3}){3}", re.I)
_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[ ().,/-]{0,2}[0-9]){5,40}")
_WORD = re.compile(r"\w+")
#: Words that often stand before such data.
_HINTS = [frozenset(x.split()) for x in (
    "mail email e-mail contact write address", "ip host server address from",
    "card visa credit payment account pay", "phone tel call mobile fax cell number whatsapp")]
FEATURES = ["kind", "length", "digits", "letters", "groups", "longest_group", "shortest_group", "spaces", "dots", "dashes",
            "brackets", "at_signs", "digit_share", "leading_zero", "hint", "word_before", "word_after", "touches_before",
            "touches_after", "last_label", "luhn", "octets", "plus"]


def proposals(text: str) -> list[Span]:
    """Spans that may be personal data, each for the kinds it may be."""
    found: set[Span] = set()
    if "@" in text:
        found.update((m.start(), 0, m.end()) for m in _AT.finditer(text))
        found.update((a, 0, b) for a, b in _emails(text))
    low = text.lower() if "[" in text or "(" in text else ""
    if "(at)" in low or "[at]" in low:
        found.update((m.start(), 0, m.end()) for m in _SPELT.finditer(text))
    if any(x in low for x in ("[.]", "(.)", "[dot]", "(dot)")):
        found.update((m.start(), 1, m.end()) for m in _BRACKETED.finditer(text))
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            dots, digits = m[0].count("."), sum(c.isdigit() for c in m[0])
            if dots >= 3:
                found.add((m.start(), 1, m.end()))
            if digits >= 12:
                found.add((m.start(), 2, m.end()))
            if 7 <= digits <= 15 and dots < 3:
                found.add((m.start(), 3, m.end()))
        found.update(s for s in base_spans(text) if s[1])
    return sorted(found)


def features(text: str, span: Span) -> list[float]:
    start, kind, end = span
    body = text[start:end].lstrip("+")
    runs = re.findall("[0-9]+", body)
    groups = [len(g) for g in runs]
    digits = sum(groups)
    before, after = text[max(0, start - 40):start], text[end:end + 20]
    words = [w.lower() for w in _WORD.findall(before)][-3:]
    return [kind, len(body), digits, sum(c.isalpha() for c in body), len(groups), max(groups, default=0),
            min(groups, default=0), body.count(" "), body.count("."), body.count("-"), body.count("(") + body.count(")"),
            body.count("@"), digits / len(body), float(body.lstrip("(")[:1] == "0"),
            float(any(w in _HINTS[kind] for w in words)), float(bool(words)), float(bool(_WORD.search(after))),
            float(before[-1:].isalnum()), float(after[:1].isalnum()), len(body.rpartition(".")[2]) if kind == 0 else 0,
            float(12 <= digits <= 19 and _luhn("".join(runs))), float(len(runs) == 4 and all(map(_small, runs))),
            float("+" in text[start:start + 2])]


def respelt(kind: int, body: str) -> list[tuple[str, bool]]:
    """A base span written in other ways, which keep it what it is, or break it."""
    if kind == 0:
        name, _, host = body.partition("@")
        return [(f"{name} (at) {host}", True), (f"{name}[at]{host.replace('.', '[dot]')}", True),
                (f"{name} (at) {host.replace('.', ' (dot) ')}", True), (f"{name}@{host.partition('.')[0]}", False)]
    if kind == 1:
        parts = body.split(".")
        broken = [*parts[:3], str(256 + int(parts[3].lstrip("0") or 0))]
        return [("[.]".join(parts), True), ("(.)".join(parts), True), ("[dot]".join(parts), True),
                ("[.]".join(broken), False), ("(.)".join(broken), False), ("[dot]".join(broken), False), (".".join(broken), False)]
    if kind == 2:
        digits = body.replace(" ", "").replace("-", "")
        broken = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [(sep.join(d[i:i + 4] for i in range(0, len(d), 4)), d == digits)
                for sep in (".", "/", "  ") for d in (digits, broken)] + [(broken, False)]
    rest = body[1:]
    seventh = [i for i, c in enumerate(body) if c in "0123456789"][6]
    ways = [(rest, True), ("00" + rest, True), (re.sub("[ .-]+", "/", body), True), (rest[:seventh], False)]
    return ways if not rest.isdigit() else [("00" + rest, True)]


def _held_out(string: str) -> bool:
    return hashlib.md5(string.encode("utf-8", "replace")).digest()[0] % 4 == 0


class _Taken:
    """Parts of a text that spans have taken, apart from each other and in order."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, _, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, span: Span) -> bool:
        at = bisect_left(self.starts, span[2])
        return at > 0 and self.ends[at - 1] > span[0]

    def add(self, span: Span) -> None:
        """A span that touches none."""
        at = bisect_left(self.starts, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


def examples(text: str, held_out: bool) -> Iterator[tuple[str, Span, bool]]:
    """(text, proposal, whether it is right), of strings that are kept out of the fit, or of the others with base spans."""
    found = proposals(text)
    base = base_spans(text) if found else []
    taken, known = _Taken(base), set(base)
    for s in found:
        if _held_out(text[s[0]:s[2]]) == held_out:
            if not taken.touches(s):
                yield text, s, False
            elif s in known and not held_out:
                yield text, s, True
    for a, k, b in base:
        if _held_out(text[a:b]) != held_out:
            continue
        before, after = text[max(0, a - 60):a], text[b:b + 40]
        for way, right in respelt(k, text[a:b]):
            window, low, high = before + way + after, len(before), len(before) + len(way)
            kept = _Taken(base_spans(window))
            for s in proposals(window):
                if s[0] < high and low < s[2] and not kept.touches(s):
                    yield window, s, right and s == (low, k, high)


@dataclass
class PiiModel:
    """Boosted trees as arrays, and the least score for each kind."""
    thresholds: list[float] = field(default_factory=lambda: [float("inf")] * len(KINDS))
    trees: list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for weight, column, cut, left, right, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = column[node] >= 0
                low = x[np.arange(len(x)), np.maximum(column[node], 0)] <= cut[node]
                node = np.where(inner, np.where(low, left[node], right[node]), node)
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans."""
        base = base_spans(text)
        if not self.trees or min(self.thresholds) > 1:
            return base, base
        taken = _Taken(base)
        open_ = [s for s in proposals(text) if self.thresholds[s[1]] <= 1 and not taken.touches(s)]
        if not open_:
            return base, base
        scores = self.scores(np.array([features(text, s) for s in open_]))
        added: list[Span] = []
        for score, s in sorted(zip(scores.tolist(), open_), key=lambda x: (-x[0], x[1])):
            if score >= self.thresholds[s[1]] and not taken.touches(s):
                taken.add(s)
                added.append(s)
        return base, sorted(base + added)


def _tree_arrays(weight: float, tree) -> tuple:
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][:2] = [split.featureIndex(), split.threshold()]
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        return at

    walk(tree._call_java("rootNode"))
    column, cut, left, right, value = zip(*rows)
    return weight, np.array(column, int), np.array(cut), np.array(left, int), np.array(right, int), np.array(value)


def train(df: DataFrame, doc_id: str = "doc_id", text: str = "text", docs: int = TRAINING_DOCS) -> PiiModel:
    """Trees from examples in about `docs` rows, thresholds from those of all rows. Runs jobs when called."""
    share = 1 << 20
    total = df.count()
    below = min(share, -(-share * docs // max(1, total)))
    picked = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(
        F.col("text").isNotNull() & (F.pmod(F.xxhash64("id", "text"), F.lit(share)) < below))

    def task(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                x, y = [], []
                for t in batch.column(1).slice(start, 256).to_pylist():
                    for window, s, right in examples(t, held_out=False):
                        x.append(features(window, s))
                        y.append(float(right))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64())],
                                                 names=["x", "label"])

    fitting = materialize(picked.mapInArrow(task, "x array<double>, label double"), "pii-proposals")
    if fitting.select("label").distinct().count() < 2:
        return PiiModel()
    fitted = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1).fit(
        fitting.select("label", array_to_vector("x").alias("v")))
    model = PiiModel(trees=[_tree_arrays(w, t) for w, t in zip(fitted.treeWeights, fitted.trees)])
    counts = score_counts(df, model, text).toArrow()
    kind, step, n, right = (counts.column(c).to_numpy() for c in ("kind", "step", "n", "n_right"))
    model.thresholds = [_calibrated(step[kind == k], n[kind == k], right[kind == k]) for k in range(len(KINDS))]
    return model


def score_counts(df: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """(kind, step, n, n_right): the examples kept out of the fit in all rows by kind and score, and how many are right."""
    def task(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                x, keys, right = [], [], []
                for t in batch.column(0).slice(start, 256).to_pylist():
                    for window, s, is_right in examples(t, held_out=True):
                        x.append(features(window, s))
                        keys.append(s[1])
                        right.append(is_right)
                if x:
                    steps = np.floor(model.scores(np.array(x)) * SCORE_STEPS).astype(np.int64)
                    found, place = np.unique(np.array(keys) * (SCORE_STEPS + 1) + steps, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((found // (SCORE_STEPS + 1)).astype(np.int32)), pa.array((found % (SCORE_STEPS + 1)).astype(np.int32)),
                         pa.array(np.bincount(place)), pa.array(np.bincount(place, right).astype(np.int64))],
                        names=["kind", "step", "n", "n_right"])

    given = df.select(F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    return given.mapInArrow(task, "kind int, step int, n long, n_right long").groupBy("kind", "step").agg(
        F.sum("n").alias("n"), F.sum("n_right").alias("n_right"))


def _calibrated(steps: np.ndarray, counts: np.ndarray, rights: np.ndarray) -> float:
    """The lowest score from which on enough of the proposals are right, or infinity."""
    order = np.argsort(-steps)
    n, right = np.cumsum(counts[order]), np.cumsum(rights[order])
    good = (right >= PRECISION * n) & (n >= LEAST_FOUND)
    return float(steps[order][np.flatnonzero(good)[-1]] / SCORE_STEPS) if good.any() else float("inf")


def find(df: DataFrame, model: PiiModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of the base spans and all spans as text."""
    kind = df.schema[doc_id].dataType.simpleString()
    names = [f"n_{k}" for k in KINDS]

    def task(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                cut = batch.slice(start, 512)
                counts, digests, spans = [], [], []
                for t in cut.column(1).to_pylist():
                    base, every = model.spans(t or "")
                    counts.append([sum(s[1] == k for s in base) for k in range(len(KINDS))])
                    digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                    spans.append(spans_text(every))
                yield pa.RecordBatch.from_arrays(
                    [cut.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))),
                     pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                    names=["doc_id", *names, "base_sha256", "spans"])

    schema = f"doc_id {kind}, {', '.join(n + ' long' for n in names)}, base_sha256 string, spans string"
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(task, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap become one."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, model: PiiModel, text: str = "text") -> DataFrame:
    """`df` with personal data masked; a null text stays null."""
    added = fresh(df, "masked")

    def task(batches):
        for batch in batches:
            place = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, 512):
                cut = batch.slice(start, 512)
                masked = [t if t is None else redacted(t, model.spans(t)[1]) for t in cut.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(masked, pa.string())],
                                                 names=[*cut.schema.names, added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    out = df.mapInArrow(task, f"{fields}, `{added}` string")
    changed = {text: F.col(added)}
    if "n_chars" in df.columns:
        changed["n_chars"] = F.when(F.col(text).eqNullSafe(F.col(added)), F.col("n_chars")).otherwise(
            F.length(added).cast(df.schema["n_chars"].dataType))
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in df.columns])
