"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent 1- to 3-grams of letters, words padded with a separator. A
text's own profile is compared to each language's by the out-of-place distance: the sum of rank
differences, where a missing n-gram costs a whole profile. The closest language wins, the first by
name on a tie; the score is one minus the distance's share of its largest value.

Profiles are learnt from about `MAX_PER_LANGUAGE` labelled rows of each language, or from all if there are
fewer; rows are chosen by a hash of id and text. That bound is a parameter; predictions
read every whole text. A profile has `PROFILE_SIZE` n-grams, so the profiles of up to `MAX_LANGUAGES`
languages pass through the driver; more are an error.

Defined cases: a text that is null or has no letter, and any text if no language was learnt, gets `und`
and score 0. Repeated rows are predicted one by one. Rows with a null language or text teach nothing.
Ties in frequency go to the smaller n-gram by code points. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.arrays import Run, map_runs, runs

PROFILE_SIZE = 300
MAX_PER_LANGUAGE = 2000
MAX_LANGUAGES = 1000
UNDETERMINED = "und"

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is none."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _letters = table
    return _letters


def _codes(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows, 0 for other characters and before, between and after rows; the row of each."""
    try:
        text = run.data.tobytes().decode()
        lead = np.zeros(len(run.data) + 1, np.int64)
        np.cumsum((run.data & 0xC0) != 0x80, out=lead[1:])
        sizes = np.diff(lead[run.offsets])
    except UnicodeDecodeError:
        parts = [t.decode("utf-8", "replace") for t in run.texts()]
        text, sizes = "".join(parts), np.array([len(p) for p in parts])
    letters = _letter_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    rows = np.repeat(np.arange(run.rows), sizes)
    out = np.zeros(len(letters) + run.rows + 1, np.uint32)
    of = np.zeros(len(out), np.int64)
    at = np.arange(len(letters)) + rows + 1
    out[at], of[at] = letters, rows
    return out, of


@dataclass
class Profiles:
    """Rows' n-grams in order of row and rank: `row`, `gram` (three code points of 21 bits), `count`, `rank`."""
    row: np.ndarray
    gram: np.ndarray
    count: np.ndarray
    rank: np.ndarray


def _ranked(letters: np.ndarray, of: np.ndarray, n_rows: int, size: int | None) -> Profiles:
    """The n-grams of each row by falling count; only the first `size` of each, if given."""
    alphabet = np.unique(letters)
    alphabet = alphabet[alphabet > 0]
    # Symbols: 0 none, 1 separator, then letters in order.
    symbol_of = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 1, np.uint64)
    symbol_of[alphabet] = np.arange(len(alphabet), dtype=np.uint64) + np.uint64(2)
    symbol_of[0] = 1
    s = symbol_of[letters]
    b = np.uint64(int(len(alphabet) + 2).bit_length())
    width = int(3 * b)
    wide = width + int(n_rows).bit_length() > 32
    row = of.astype(np.uint64) << np.uint64(width)
    letter = letters > 0
    one = (row | (s << (b + b)))[letter]
    pair = letter[:-1] | letter[1:]
    two = (np.where(letter[:-1], row[:-1], row[1:]) | (s[:-1] << (b + b)) | (s[1:] << b))[pair]
    mid = letter[1:-1]
    three = (row[1:-1] | (s[:-2] << (b + b)) | (s[1:-1] << b) | s[2:])[mid]
    keys = np.concatenate([one, two, three])
    keys, count = np.unique(keys if wide else keys.astype(np.uint32), return_counts=True)
    keys = keys.astype(np.uint64)
    row, gram = keys >> np.uint64(width), keys & np.uint64((1 << width) - 1)
    top = int(count.max()) if len(count) else 0
    if top.bit_length() + width + int(n_rows).bit_length() <= 64:
        by = (((row << np.uint64(top.bit_length())) | (top - count).astype(np.uint64)) << np.uint64(width)) | gram
        by = np.sort(by)
        gram = by & np.uint64((1 << width) - 1)
        by >>= np.uint64(width)
        count = top - (by & np.uint64((1 << top.bit_length()) - 1)).astype(np.int64)
        row = by >> np.uint64(top.bit_length())
    else:
        order = np.lexsort((gram, -count, row))
        row, gram, count = row[order], gram[order], count[order]
    row = row.astype(np.int64)
    n = np.bincount(row, minlength=n_rows)
    rank = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    if size is not None:
        use = rank < size
        row, gram, count, rank = row[use], gram[use], count[use], rank[use]
    code = np.concatenate([[0, 1], alphabet]).astype(np.int64)
    low = np.uint64((1 << int(b)) - 1)
    gram = (code[gram >> (b + b)] << 42) | (code[(gram >> b) & low] << 21) | code[gram & low]
    return Profiles(row, gram, count, rank)


def learn_profiles(df: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id",
                   size: int = PROFILE_SIZE, max_per_language: int = MAX_PER_LANGUAGE) -> DataFrame:
    """(lang, gram, rank) of every language of `df`, ranks from 0. Runs a job when called: the languages are counted."""
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("__text"), F.col(doc_id).alias("id")).where(
        F.col("lang").isNotNull() & F.col("__text").isNotNull())
    share = 1 << 20
    counts = rows.groupBy("lang").agg(F.ceil(F.lit(float(share * max_per_language)) / F.count("*")).alias("below"))
    known = counts.limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    wanted = df.sparkSession.createDataFrame(known, counts.schema)
    chosen = rows.join(F.broadcast(wanted), "lang").where(
        F.pmod(F.xxhash64("id", "__text"), F.lit(share)) < F.col("below")).select("lang", "__text")

    def task(batches):
        for batch in batches:
            for run in runs(batch, "__text"):
                names, at = np.unique(batch.column(0).slice(run.first, run.rows).to_numpy(zero_copy_only=False).astype(str),
                                      return_inverse=True)
                letters, of = _codes(run)
                found = _ranked(letters, at[of], len(names), None)
                yield pa.RecordBatch.from_arrays([pa.array(names[found.row]), pa.array(found.gram), pa.array(found.count)],
                                                 names=["lang", "gram", "n"])

    grams = chosen.mapInArrow(task, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return grams.withColumn("rank", rank - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


class Languages:
    """Profiles as arrays: all n-grams in order, and their rank in each language."""

    def __init__(self, profiles: DataFrame, size: int = PROFILE_SIZE):
        rows = profiles.toArrow()
        self.size = size
        self.names, of = np.unique(rows.column("lang").to_numpy().astype(str), return_inverse=True)
        self.grams, at = np.unique(rows.column("gram").to_numpy(), return_inverse=True)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        self.ranks[at, of] = rows.column("rank").to_numpy()

    def closest(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the closest language's number, its score, and whether there is one."""
        n = run.rows
        if not len(self.names):
            return np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
        own = _ranked(*_codes(run), n, self.size)
        sizes = np.bincount(own.row, minlength=n)
        place = np.searchsorted(self.grams, own.gram)
        place = np.where((place < len(self.grams)) & (self.grams[np.minimum(place, len(self.grams) - 1)] == own.gram),
                         place, len(self.grams))
        distances = np.empty((n, len(self.names)))
        for k in range(len(self.names)):
            theirs = self.ranks[place, k]
            distances[:, k] = np.bincount(own.row, np.where(theirs < 0, self.size, np.abs(theirs - own.rank)), n)
        best = distances.argmin(axis=1)
        known = sizes > 0
        score = np.where(known, 1 - distances[np.arange(n), best] / np.maximum(1, sizes * self.size), 0.0)
        return best, score, known


def identify(df: DataFrame, languages: Languages, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep`, lang_pred and score of every row."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["lang_pred string", "score double"])

    def work(run: Run, fields: dict[str, pa.Array]) -> pa.RecordBatch:
        best, score, known = languages.closest(run)
        names = [*languages.names.tolist(), UNDETERMINED]
        picked = pa.array(names).take(pa.array(np.where(known, best, len(names) - 1)))
        return pa.RecordBatch.from_arrays([*fields.values(), picked, pa.array(score)],
                                          names=[*keep, "lang_pred", "score"])

    return map_runs(df, text, keep, schema, work)
