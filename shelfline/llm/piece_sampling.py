"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

A text is cut only between characters that stand side by side in no piece of the vocabulary, so its lattice of
all ways to cover it by pieces is the product of those of its segments. Runs of spaces stay whole, as do long
words and texts without spaces where pieces hold them together.
Forward filtering sums their probabilities up to each character; backward sampling then draws pieces from
the end, each in proportion to its share of the sum. A draw depends on the row's key, the seed, the
segment's number and the step alone, so a row is cut the same way in any partition, batch or attempt.

Pieces of a unigram model have log probabilities. Those of a byte-pair model have only ranks; then a piece
of rank r weighs 1 / (r + `RANK_OFFSET`), as word frequencies do. `alpha` sharpens (above 1) or flattens.
A character without a piece, and a literal U+2581, becomes its UTF-8 bytes, so decoding gives back
every text exactly.

Lattices are worked out once per distinct segment of a run of rows; filtering and draws are vectorised over all
segments of up to `SEGMENT_CHARS` characters. Longer ones are filtered one by one, with sums scaled to lie
near one at every character, in time and memory in proportion to their length.

Defined cases: a null or empty text has no pieces and decodes to the empty text. Repeated rows with one key
get the same segmentation; a null key is a key like any other. An empty table gives an empty result. Other
columns are carried if asked for, or ignored; one that is named like a result gives way to it.

The model file is read by the driver, from a path or an address that it can open, and sent to the executors.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from math import frexp, ldexp

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.arrays import U64, Run, fresh, map_runs, mixed
from shelfline.llm.storage import open_folder

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_BYTES = 1 << 26
RANK_OFFSET = 10.0
SEGMENT_CHARS = 48
SEED = 5
_SPACE = "▁"
_WORDS = re.compile(r" *[^ \n]+| +|\n")
_BITS = 53
_FALLBACK = 1 << 24


class Vocabulary:
    """The pieces of a model with their weights, and what each id decodes to."""

    def __init__(self, content: bytes, alpha: float = 1.0):
        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        n = model.get_piece_size()
        kept = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        scores = {i: model.get_score(i) for i in kept}
        ranks = all(s == int(s) and s <= 0 for s in scores.values())
        self.bytes_: list[bytes] = [b""] * n
        self.byte_ids = [0] * 256
        self.weights: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        total = sum(1 / (RANK_OFFSET - s) for s in scores.values()) if ranks else 1.0
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value], self.bytes_[i] = i, bytes([value])
        for i in kept:
            piece = model.id_to_piece(i).replace(_SPACE, " ")
            self.bytes_[i] = piece.encode()
            weight = 1 / ((RANK_OFFSET - scores[i]) * total) if ranks else float(np.exp(scores[i]))
            # A factor per character changes no proportion and keeps products near one.
            self.weights[piece] = weight ** alpha * 200.0 ** len(piece)
            self.ids[piece] = i
        self.rare = min(self.weights[p] / 200.0 ** len(p) for p in self.weights) * 200.0
        self.longest = max(map(len, self.ids))
        self.joined = {piece[i:i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        # Without pieces that hold a line break, or a space behind anything but a space, words are cut off by one pattern.
        self.by_words = not any("\n" in pair or (pair[1] == " " and pair != "  ") for pair in self.joined)
        self._make_trie()

    def _make_trie(self) -> None:
        """The pieces as a trie in arrays: children by (node, character), and the piece that ends at a node."""
        alphabet = sorted({c for piece in self.ids for c in piece})
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        self.letters = len(alphabet)
        number = {c: i for i, c in enumerate(alphabet)}
        children: dict[tuple[int, int], int] = {}
        ends = {}
        for piece, i in self.ids.items():
            node = 0
            for c in piece:
                node = children.setdefault((node, number[c]), len(children) + 1)
            ends[node] = i, self.weights[piece]
        # Open addressing with a third of the places in use at most.
        self.shift = U64(64 - (3 * len(children)).bit_length())
        size = 1 << (64 - int(self.shift))
        self.keys, self.child = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        keys = np.array([n * self.letters + c for n, c in children], np.int64)
        for place, key, child in zip(self._place(keys).tolist(), keys.tolist(), children.values()):
            while self.keys[place] >= 0:
                place = (place + 1) % size
            self.keys[place], self.child[place] = key, child
        self.ending = np.full(len(children) + 1, -1, np.int32)
        self.weight = np.zeros(len(children) + 1)
        for node, (i, w) in ends.items():
            self.ending[node], self.weight[node] = i, w

    def segments(self, text: str) -> list[str]:
        """The text cut where no piece can cross; short words are left whole, as fewer segments are quicker."""
        out = []
        for word in _WORDS.findall(text) if self.by_words else [text] if text else []:
            if len(word) <= SEGMENT_CHARS:
                out.append(word)
                continue
            begin = 0
            for at in range(1, len(word)):
                if word[at - 1:at + 1] not in self.joined:
                    out.append(word[begin:at])
                    begin = at
            out.append(word[begin:])
        return out

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(U64) * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The child of each node by a character, or -1."""
        key = node.astype(np.int64) * self.letters + letter
        place = self._place(key)
        there = self.keys[place]
        found = np.where(there == key, self.child[place], -1)
        found[letter < 0] = -1
        open_ = np.flatnonzero((there != key) & (there >= 0) & (letter >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) % len(self.keys)
            there = self.keys[place[open_]]
            hit = there == key[open_]
            found[open_[hit]] = self.child[place[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found


class Lattices:
    """The lattices of some distinct segments: for each of their characters, the pieces that end there."""

    def __init__(self, segments: list[str], vocabulary: Vocabulary):
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = vocabulary.letter[codes]
        self.first = np.cumsum(sizes) - sizes
        stop_of = np.repeat(self.first + sizes, sizes)
        place_of = np.arange(len(codes)) - np.repeat(self.first, sizes)
        starts, stops, pieces, weights = [], [], [], []
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int32)
        length = 0
        while len(at):
            node = vocabulary.step(node, letter[at + length])
            length += 1
            alive = node >= 0
            if length == 1:
                lone = at[~alive | (vocabulary.ending[node] < 0)]
                starts.append(lone), stops.append(lone), weights.append(np.full(len(lone), vocabulary.rare))
                pieces.append(_FALLBACK + codes[lone].astype(np.int64))
            at, node = at[alive], node[alive]
            whole = vocabulary.ending[node] >= 0
            starts.append(at[whole]), stops.append(at[whole] + length - 1)
            pieces.append(vocabulary.ending[node[whole]].astype(np.int64)), weights.append(vocabulary.weight[node[whole]])
            more = at + length < stop_of[at]
            at, node = at[more], node[more]
        start, stop = np.concatenate(starts), np.concatenate(stops)
        # By the last character's place in its segment, then by segment, then by length: each list above is in order.
        order = np.argsort(stop, kind="stable")
        order = order[np.argsort(place_of[stop[order]].astype(np.uint8), kind="stable")]
        start, stop = start[order], stop[order]
        self.piece, weight = np.concatenate(pieces)[order], np.concatenate(weights)[order]
        self.back = place_of[start]
        self._filter(start, stop, weight, place_of)

    def _filter(self, start: np.ndarray, stop: np.ndarray, weight: np.ndarray, place_of: np.ndarray) -> None:
        """Forward filtering, one place of all segments at a time; leaves the shares of the pieces of each node.

        Sums are added up in one order whatever other segments there are, so a segment's shares never vary.
        """
        new = np.ones(len(stop), bool)
        new[1:] = stop[1:] != stop[:-1]
        node = np.cumsum(new) - 1
        rank = np.arange(len(stop)) - np.flatnonzero(new)[node]
        self.node_of = np.empty(len(place_of), np.int64)
        self.node_of[stop] = node
        # `sums[i]` is that of the place behind the character i; a segment's start has 1.
        sums = np.ones(len(place_of))
        total = np.zeros(len(stop))
        mass = np.zeros(len(stop))
        bounds = np.searchsorted(place_of[stop], np.arange(SEGMENT_CHARS + 2))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if low == high:
                continue
            part = slice(low, high)
            inner = place_of[start[part]] > 0
            mass[part] = weight[part] * np.where(inner, sums[start[part] - 1], 1.0)
            total[part] = mass[part]
            ranks = rank[part]
            for r in range(1, int(ranks.max()) + 1):
                at = low + np.flatnonzero(ranks == r)
                total[at] = total[at - 1] + mass[at]
            sums[stop[part]] = total[part]
        last = np.append(new[1:], True)
        whole = total[np.flatnonzero(last)][node]
        share = np.minimum(1 << _BITS, (total / whole * (1 << _BITS)).astype(np.int64))
        share[last] = 1 << _BITS
        self.shares = share
        self.first_piece = np.flatnonzero(new)

    def sample(self, numbers: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling: the pieces of each segment in order, and their number per segment."""
        first = self.first[numbers] - 1
        place = lengths.astype(np.int64)
        active = np.arange(len(numbers))
        drawn, step = [], 0
        while len(active):
            node = self.node_of[first[active] + place[active]]
            draw = (mixed(keys[active] + U64(step)) >> U64(64 - _BITS)).astype(np.int64)
            # A node has few pieces, so a step along them is quicker than a search.
            edge = self.first_piece[node]
            low = np.flatnonzero(self.shares[edge] <= draw)
            while len(low):
                edge[low] += 1
                low = low[self.shares[edge[low]] <= draw[low]]
            drawn.append((active, self.piece[edge]))
            place[active] = self.back[edge]
            active = active[place[active] > 0]
            step += 1
        counts = np.zeros(len(numbers), np.int64)
        for at, _ in drawn:
            counts[at] += 1
        end = np.cumsum(counts)
        out = np.zeros(int(end[-1]) if len(end) else 0, np.int64)
        for step, (at, pieces) in enumerate(drawn):
            out[end[at] - 1 - step] = pieces
        return out, counts


class LongLattice:
    """The forward sums of one long segment: that up to a place is `sums[place]` times 2 to the `powers[place]`."""

    def __init__(self, segment: str, vocabulary: Vocabulary):
        self.segment, self.vocabulary = segment, vocabulary
        self.sums, self.powers = array("d", [1.0]), array("q", [0])
        for stop in range(1, len(segment) + 1):
            mantissa, power = frexp(sum(mass for _, _, mass in self._edges(stop)))
            self.sums.append(mantissa)
            self.powers.append(self.powers[stop - 1] + power)

    def _edges(self, stop: int) -> Iterator[tuple[int, int, float]]:
        """(start, piece, mass) of the pieces that end at a place, on the scale of the place before."""
        weights, sums, powers = self.vocabulary.weights, self.sums, self.powers
        for start in range(stop - 1, max(0, stop - self.vocabulary.longest) - 1, -1):
            piece = self.segment[start:stop]
            weight = weights.get(piece)
            if weight is not None:
                yield start, self.vocabulary.ids[piece], ldexp(weight * sums[start], powers[start] - powers[stop - 1])
            elif start == stop - 1:
                yield start, _FALLBACK + ord(piece), self.vocabulary.rare * sums[start]

    def sample(self, key: int) -> array:
        """Backward sampling: the pieces in order."""
        drawn = array("q")
        stop = len(self.segment)
        while stop:
            # Draws come from the same stream as those of short segments.
            if len(drawn) % 4096 == 0:
                draws = mixed(np.arange(len(drawn), len(drawn) + 4096).astype(U64) + U64(key)) >> U64(64 - _BITS)
            edges = list(self._edges(stop))
            left = int(draws[len(drawn) % 4096]) / (1 << _BITS) * sum(mass for _, _, mass in edges)
            for start, piece, mass in edges:
                if left < mass:
                    break
                left -= mass
            drawn.append(piece)
            stop = start
        drawn.reverse()
        return drawn


_vocabularies: dict = {}


def vocabulary_of(content: bytes, alpha: float = 1.0) -> Vocabulary:
    """The vocabulary of a model file's bytes, made once per process."""
    if (content, alpha) not in _vocabularies:
        _vocabularies[content, alpha] = Vocabulary(content, alpha)
    return _vocabularies[content, alpha]


def read_model(path: str) -> bytes:
    """A model file of at most `MODEL_BYTES`, so that it may be sent to every executor."""
    system, inner = open_folder(path)
    with system.open_input_stream(inner, compression=None) as stream:
        content = stream.read(MODEL_BYTES + 1)
    if len(content) > MODEL_BYTES:
        raise ValueError(f"{path} has more than {MODEL_BYTES} bytes")
    return content


def _sampled(distinct: list[str], known: np.ndarray, seeds: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of each occurrence `known` of a distinct segment in order, and their number per occurrence."""
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    short = sizes <= SEGMENT_CHARS
    if short.all():
        return Lattices(distinct, vocabulary).sample(known, sizes[known], seeds)
    counts = np.zeros(len(known), np.int64)
    some = np.flatnonzero(short[known])
    few = np.zeros(0, np.int64)
    if len(some):
        new_number = np.cumsum(short) - 1
        lattices = Lattices([s for s, fits in zip(distinct, short) if fits], vocabulary)
        few, counts[some] = lattices.sample(new_number[known[some]], sizes[known[some]], seeds[some])
    long = np.flatnonzero(~short[known])
    drawn: dict[int, array] = {}
    # Occurrences of one segment follow each other, so one long lattice at a time is kept.
    for at in long[np.argsort(known[long], kind="stable")].tolist():
        if not drawn or known[at] != held:
            held = known[at]
            lattice = LongLattice(distinct[held], vocabulary)
        drawn[at] = lattice.sample(int(seeds[at]))
        counts[at] = len(drawn[at])
    start = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    own = counts[some]
    out[np.repeat(start[some] - (np.cumsum(own) - own), own) + np.arange(len(few))] = few
    for at, pieces in drawn.items():
        out[start[at]:start[at] + len(pieces)] = pieces
    return out, counts


def encode_run(run: Run, keys: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all rows, and their number per row."""
    segments: list[str] = []
    per_row = np.zeros(run.rows, np.int64)
    for i, raw in enumerate(run.texts()):
        own = vocabulary.segments(raw.decode("utf-8", "replace"))
        per_row[i] = len(own)
        segments += own
    if not segments:
        return np.zeros(0, np.int64), np.zeros(run.rows, np.int64)
    rows = np.repeat(np.arange(run.rows), per_row)
    number = np.arange(len(segments)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    index = {s: i for i, s in enumerate(dict.fromkeys(segments))}
    distinct = list(index)
    known = np.fromiter(map(index.__getitem__, segments), np.int64, len(segments))
    seeds = mixed(mixed(keys[rows]) + number.astype(U64)) << U64(8)
    pieces, counts = _sampled(distinct, known, seeds, vocabulary)
    owner = np.repeat(rows, counts)
    if (pieces >= _FALLBACK).any():
        byte_ids = vocabulary.byte_ids
        far = np.flatnonzero(pieces >= _FALLBACK)
        raw = [chr(c).encode() for c in (pieces[far] - _FALLBACK).tolist()]
        sizes = np.ones(len(pieces), np.int64)
        sizes[far] = [len(b) for b in raw]
        start = np.cumsum(sizes) - sizes
        out = np.repeat(pieces, sizes)
        for at, body in zip(start[far].tolist(), raw):
            for k, value in enumerate(body):
                out[at + k] = byte_ids[value]
        pieces, owner = out, np.repeat(owner, sizes)
    return pieces, np.bincount(owner, minlength=run.rows)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, model: str = MODEL,
           alpha: float = 1.0, seed: int = SEED, verified: str | None = None) -> DataFrame:
    """The columns `keep` (default: the key) and `piece_ids`, one sampled segmentation of each row.

    With `verified`, a boolean column of that name says whether the pieces decode to the text again.
    """
    added = [verified] if verified else []
    results = {c.lower() for c in ("piece_ids", *added)}
    keep = [c for c in ([key] if keep is None else keep) if c.lower() not in results]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    body_name, key_name = fresh(df, "text"), fresh(df, "key")
    given = df.select(*[F.col(c) for c in keep], F.col(text).alias(body_name),
                      F.xxhash64(F.col(key), F.lit(seed)).alias(key_name))
    content = df.sparkSession.sparkContext.broadcast(read_model(model))

    def work(run: Run, fields: dict[str, pa.Array]) -> pa.RecordBatch:
        keys = fields.pop(key_name).to_numpy(zero_copy_only=False).view(U64)
        vocabulary = vocabulary_of(content.value, alpha)
        pieces, counts = encode_run(run, keys, vocabulary)
        cuts = np.concatenate([[0], np.cumsum(counts)])
        columns = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(pieces.astype(np.int32)))]
        if verified:
            body = vocabulary.bytes_
            columns.append(pa.array([b"".join([body[i] for i in pieces[a:b].tolist()]) == text for a, b, text in zip(
                cuts[:-1].tolist(), cuts[1:].tolist(), run.texts())], pa.bool_()))
        return pa.RecordBatch.from_arrays([*fields.values(), *columns], names=[*keep, "piece_ids", *added])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["piece_ids array<int>", *(f"`{c}` boolean" for c in added)])
    return map_runs(given, body_name, [*keep, key_name], schema, work)


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    return b"".join([vocabulary.bytes_[i] for i in ids]).decode("utf-8", "replace")


def decode(df: DataFrame, pieces: str = "piece_ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """`df` with the text of its piece ids; null pieces give the empty text. A column called `name` is replaced."""
    content = df.sparkSession.sparkContext.broadcast(read_model(model))
    kept = [f for f in df.schema.fields if f.name.lower() != name.lower()]

    def task(batches):
        vocabulary = vocabulary_of(content.value)
        for batch in batches:
            place = batch.schema.get_field_index(pieces)
            for start in range(0, batch.num_rows, 256):
                cut = batch.slice(start, 256)
                texts = [decode_ids(ids or [], vocabulary) for ids in cut.column(place).to_pylist()]
                own = [cut.column(cut.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], names=[*(f.name for f in kept), name])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return df.mapInArrow(task, f"{fields}`{name}` string")
