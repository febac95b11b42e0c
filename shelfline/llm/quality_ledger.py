"""Quality rules as a bit ledger: measure every text once, keep failure bits, apply policies afterwards.

`ledger` evaluates each rule once and stores its bit and its measurements. A policy is a set of rules
and the number of them that may fail; versions of a policy, and the effect of leaving a rule out,
come from the stored bits alone.

Defined cases: a null text has no words and fails like an empty one. Repeated rows are judged one by
one. Columns of the input other than the text are carried along; a clash with a ledger column is
settled by keeping the ledger's. An empty table gives an empty ledger, and ablations of zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.arrays import U64, Run, map_runs, mixed, span_counts, span_hashes, words

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words",
            "n_distinct_words"]


@dataclass(frozen=True)
class Rule:
    """`fails` is a SQL condition over the measurements; null counts as not failing."""
    name: str
    fails: str


#: The place of a rule in the list is its bit; rules are only ever added at the end.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    # Length alone is no fault, so no policy here uses this one; it marks texts for other policies.
    Rule("many_words", "n_words > 1000000"),
    Rule("short_mean_word", "word_chars < 2 * n_words"),
    Rule("long_mean_word", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    # A repeated line or two in a short text is no fault.
    Rule("repeated_lines", "2 * n_dup_lines > n_lines and n_lines >= 6"),
    Rule("few_letters", "10 * n_alpha_words < 7 * n_words"),
    Rule("few_distinct_words", "20 * n_distinct_words < n_words and n_words < 2000"),
]


@dataclass(frozen=True)
class Policy:
    """Rejects a text that fails any rule of `strict`, or more than `allowed` of `soft`."""
    version: str
    strict: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0


POLICIES = [
    Policy("base", ("few_words", "repeated_windows")),
    Policy("v1", ("few_words", "repeated_windows", "short_mean_word", "long_mean_word", "symbols",
                  "repeated_lines", "few_letters")),
    Policy("v2", ("few_words", "repeated_windows", "symbols"),
           ("short_mean_word", "long_mean_word", "repeated_lines", "few_letters", "few_distinct_words"), 1),
]
DEFAULT_POLICY = POLICIES[1]


def measure(run: Run) -> dict[str, np.ndarray]:
    """The measurements of every row of a run."""
    n, data = run.rows, run.data
    starts, ends, rows = words(run)
    first = run.offsets[:-1]
    inside = np.zeros(len(data), bool)
    if len(starts):
        change = np.zeros(len(data) + 1, np.int8)
        change[starts] += 1
        change[ends] -= 1
        inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    n_words = np.bincount(rows, minlength=n)
    codes = span_hashes(data, starts, ends)
    letters = np.zeros(256, bool)
    letters[65:91] = letters[97:123] = letters[128:] = True
    alpha = span_counts(letters[data], starts, ends) > 0
    out = {
        "n_words": n_words,
        "word_chars": span_counts(inside & ((data & 0xC0) != 0x80), first, run.offsets[1:]),
        "n_symbols": span_counts(_SYMBOLS[data], first, run.offsets[1:]),
        "n_alpha_words": np.bincount(rows[alpha], minlength=n),
        "n_distinct_words": _distinct(codes, rows, n),
        "n_repeat_words": _repeated_words(codes, rows, n),
    }
    out["n_dup_lines"], out["n_lines"] = _lines(run, starts)
    return out


def _distinct(codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    if not len(codes):
        return np.zeros(n, np.int64)
    order = np.lexsort((codes, rows))
    c, r = codes[order], rows[order]
    new = np.ones(len(c), bool)
    new[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=n)


def _repeated_words(codes: np.ndarray, rows: np.ndarray, n: int, size: int = 3) -> np.ndarray:
    """Words that lie in a window of `size` words that its text has twice or more."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.zeros(n, np.int64)
    whole = rows[:count] == rows[size - 1:]
    window = codes[:count].copy()
    for k in range(1, size):
        window = mixed(window) + codes[k:count + k]
    window = mixed(window) ^ mixed(rows[:count].astype(U64))
    at = np.flatnonzero(whole)
    order = at[np.argsort(window[at])]
    keys = window[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[1:] == keys[:-1]
    again = order[same[1:] | same[:-1]]
    covered = np.zeros(len(codes), bool)
    for k in range(size):
        covered[again + k] = True
    return np.bincount(rows[covered], minlength=n)


def _lines(run: Run, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and all lines with a word."""
    n, data = run.rows, run.data
    if not len(word_starts):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([run.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 10))
    full = np.diff(np.searchsorted(word_starts, np.append(starts, len(data)))) > 0
    starts, ends = starts[full], ends[full]
    rows = np.searchsorted(run.offsets, starts, "right") - 1
    total = np.bincount(rows, minlength=n)
    return total - _distinct(span_hashes(data, starts, ends), rows, n), total


def ledger(df: DataFrame, text: str = "text", keep: list[str] | None = None,
           rules: list[Rule] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the text), the measurements, and `failed`, one bit a rule."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in (*MEASURES, "failed")
            and (keep is not None or c != text)]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{m} long" for m in MEASURES])

    def work(run: Run, fields: dict[str, pa.Array]) -> pa.RecordBatch:
        found = measure(run)
        return pa.RecordBatch.from_arrays(
            [*fields.values(), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], names=[*keep, *MEASURES])

    measured = map_runs(df, text, keep, schema, work)
    return measured.withColumn("failed", failure_bits(rules or RULES))


def failure_bits(rules: list[Rule]) -> Column:
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def mask(names: tuple[str, ...], rules: list[Rule] | None = None) -> int:
    known = [r.name for r in rules or RULES]
    return sum(1 << known.index(x) for x in names)


def rejected(policy: Policy, bits: str = "failed", rules: list[Rule] | None = None, without: str | None = None) -> Column:
    """Whether `policy` rejects a row, optionally as if the rule `without` did not exist."""
    gone = ~mask((without,), rules) if without else -1
    strict = F.col(bits).bitwiseAND(F.lit(mask(policy.strict, rules) & gone)) != 0
    soft = F.bit_count(F.col(bits).bitwiseAND(F.lit(mask(policy.soft, rules) & gone))) > policy.allowed
    return strict | soft


def apply_policies(table: DataFrame, policies: list[Policy] | None = None) -> DataFrame:
    """A boolean `kept_<version>` for each policy."""
    return table.withColumns({f"kept_{p.version}": ~rejected(p) for p in policies or POLICIES})


def ablations(table: DataFrame, policies: list[Policy] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """(version, rule, n_rows, n_failed, n_rejected, n_rejected_without) for each policy and rule it uses.

    The ledger is first counted by its bits, at most 2 ** rules groups, combined before the shuffle.
    """
    rules = rules or RULES
    counts = table.groupBy("failed").agg(F.count("*").alias("n"))
    used = [(p, r) for p in policies or POLICIES for r in (*p.strict, *p.soft)]
    sums = [F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")]
    for k, (p, r) in enumerate(used):
        for what, test in (("failed", F.col("failed").bitwiseAND(F.lit(mask((r,), rules))) != 0),
                           ("rejected", rejected(p, rules=rules)), ("without", rejected(p, rules=rules, without=r))):
            sums.append(F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias(f"{what}{k}"))
    total = counts.agg(*sums)
    parts = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.col("n_rows"),
                               F.col(f"failed{k}").alias("n_failed"), F.col(f"rejected{k}").alias("n_rejected"),
                               F.col(f"without{k}").alias("n_rejected_without")) for k, (p, r) in enumerate(used)])
    return total.select(F.inline(parts))
