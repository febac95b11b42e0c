import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from shelfline.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, present boolean"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [(*row, kind != 0)] * (2 if kind == 3 else 1)
    return out


def cheapest(symbols):
    """From left to right over places in the pattern, every edit tried in turn; an insertion may come before any row."""
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, place, inserts):
        found = [(0, "")] if i == len(symbols) and place in (0, 3) else []
        if inserts < 3:
            for (p, role), q in steps.items():
                if p == place and role in "ua":
                    cost, audit = best(i, q, inserts + 1)
                    found.append((cost + 3, "I" + audit))
        if i < len(symbols):
            initial, fault = symbols[i]
            cost, audit = best(i + 1, place, 0)
            found.append((cost + 4, "D" + audit))
            for (p, role), q in steps.items():
                if p == place and fault not in "bd":
                    more = 3 * (fault == "t")
                    cost, audit = best(i + 1, q, 0)
                    if role == initial:
                        found.append((cost + more, "K" + audit))
                    if role in "ua":
                        found.append((cost + 3 + more, "R" + audit))
        return min(found, default=(10 ** 9, ""))

    import sys
    sys.setrecursionlimit(20000)
    return best(0, 0, 0)


def plain(rows):
    """The result by looking at one conversation after the other."""
    out = []
    for conv in {r[0] for r in rows}:
        def key(r):
            told = f"{' ' if r[0] is None else r[0]}:{len(r[2])}:{r[2]}:{r[3]}"
            return r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(told.encode()).digest()
        own = sorted((r for r in rows if r[0] == conv and r[4]), key=key)
        seen, symbols = set(), []
        for _, _, role, text, _ in own:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "-"
            seen.add((role, text))
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        turns = {r[1] for r in own} - {None}
        initials = [s[0] for s in symbols]
        cost, audit = cheapest(tuple(symbols))
        left, at, made = len(audit) - audit.count("D"), iter(own), []
        for edit in audit:
            row = next(at) if edit != "I" else None
            if edit == "D":
                continue
            place = len(made) - left % 2
            made.append(f"{row[2]}:{row[3]}" if edit == "K" else f"{'assistant' if place % 2 else 'user'}:{row[3] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(m[0] for m in made))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(s[1] == f for s in symbols) for f in "bdt"),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(made).encode()).hexdigest(), made))
    return sorted(out, key=str)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["hello.", "hello.", "why?", "and then", "", " \n", "yes!  \n", "é.\n\nx", "ok .", None])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), text))
    return rows


def digests(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, conversations, longest", [(1, 60, 5), (2, 12, 40), (3, 2, 300)])
def test_random_conversations_agree_with_plain_code(spark, seed, conversations, longest):
    rows = [r for r in random_rows(seed, conversations, longest)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    hurt = repair.damage(df)
    assert sorted(map(tuple, hurt.collect()), key=str) == sorted(damaged(rows), key=str)
    assert digests(repair.repair_digests(hurt)) == [r[:-1] for r in plain(damaged(rows))]


def test_given_conversations_agree_with_plain_code(spark, folder):
    from shelfline.llm.queries import QUERIES
    rows = list(map(tuple, spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert digests(QUERIES["op12_conversation_repair"](spark, folder)) == [r[:-1] for r in plain(damaged(rows))]


def test_one_conversation_over_many_tasks(spark):
    """A conversation that owns most rows is parsed in portions; the number of portions doesn't matter."""
    rows = [(7, t, r, x, True) for t, (_, _, r, x, _) in enumerate(damaged(random_rows(4, 40, 12)))]
    rows += [(8, 0, "user", "hi.", True), (9, 1, "user", "x", False)]
    expected = [r[:-1] for r in plain(rows)]
    for parts in ("1", "5", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert digests(repair.repair_digests(spark.createDataFrame(rows, SCHEMA).repartition(9))) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hard_rows(spark):
    rows = [(1, 1, "user", "hi."), (1, 1, "user", "hi."), (1, 1, "user", "hi."), (None, None, None, None), (None, 3, "assistant", "x."),
            (2, None, "system", "be."), (2, 5, "user", "long " * 50_000 + "."), (2, -5, "assistant", "a?"), (3, 0, "", "."), (4, 1, "s", "only.")]
    df = spark.createDataFrame([(*r, True, 1, 2) for r in rows], SCHEMA + ", digest int, symbol int")
    assert digests(repair.repair_digests(df)) == [r[:-1] for r in plain([(*r[:2], *(" " if x is None else x for x in r[2:]), True) for r in rows])]
    assert repair.repair_digests(df.where("false")).isEmpty() and repair.repair(df.where("false")).isEmpty()
    got = repair.repair_digests(spark.createDataFrame([(5, 1, "user", "x", False)], SCHEMA)).first()
    assert tuple(got) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(spark):
    rows = damaged(random_rows(5, 30, 9))
    got = {}
    for r in sorted(repair.repair(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.conv_id, r.position)):
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert got == {r[0]: r[-1] for r in plain(rows) if r[-1]}


def test_split_point_and_grouping_do_not_matter():
    """The cell of a span is the same whatever the spans it is put together from."""
    rng = random.Random(6)
    for _ in range(30):
        symbols = [rng.choice("sua?") + rng.choice("--bdt") for _ in range(rng.randint(1, 40))]
        spans = repair.Spans()
        for s in symbols:
            spans.add_row(s)
        whole = repair.parse([repair.row_cell(s) for s in symbols])
        assert spans.whole() == whole
        ends = [whole[repair.PAIRS.index((0, q))] for q in (0, 3)]
        assert min(e for e in ends if e) == cheapest(tuple(symbols))
