from __future__ import annotations

import hashlib
import random
import zlib
from itertools import pairwise

import pytest

from pricepanel.llm import conversation_repair as cr
from pricepanel.llm import oracle

from .conftest import by_name

BLANKS = " \t\n\x0b\f\r"
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def damage(rows):
    """Rows by conversation after damage, in order."""
    by_id = {}
    for conv, turn, role, text in rows:
        own = by_id.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        form = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if form == 1:
            text = ""
        if form == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if form == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(form, 1)
    for own in by_id.values():
        own.sort(
            key=lambda r: (
                r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()
            )
        )
    return by_id


def best_edits(rows, faults):
    """Cost, edits and lines by going forward over whole strings of edits."""

    def with_inserts(best):
        best = dict(best)
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                to = 3 if state == 2 else 2
                way = (cost + 5, audit + "I", [*lines, "assistant:" if to == 3 else "user:"])
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        return best

    best = {0: (0, "", [])}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        found = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            ways = [(state, 2, "D", [])]
            if fault not in ("blank", "duplicate"):
                extra, to = 5 * (fault == "truncated"), 3 if state == 2 else 2
                name = "assistant" if to == 3 else "user"
                ways.append((to, 1 + extra, "R", [f"{name}:{text}"]))
                if role[:1] in NEXT[state]:
                    ways.append((NEXT[state][role[:1]], extra, "K", [f"{role}:{text}"]))
            for to, more, letter, line in ways:
                way = (cost + more, audit + letter, lines + line)
                if to not in found or way[:2] < found[to][:2]:
                    found[to] = way
        best = found
    best = with_inserts(best)
    return min((best[s] for s in (0, 3) if s in best), key=lambda way: way[:2])


def plain(rows):
    for conv, own in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            ended = text.rstrip(BLANKS)
            faults.append(
                "blank" if not ended
                else "duplicate" if (role, text) in seen
                else "truncated" if ended[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(
            a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(own)
        )
        cost, audit, lines = best_edits(own, faults)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
        yield (conv, gaps, *counts, illegal, cost, audit, sha)


ROLES = ("system", "user", "assistant", "tool", "user", "assistant")


def conversation(conv, n, roles=ROLES, seed=3):
    rng = random.Random(seed + (conv or 0))
    ends = (".", "!", "? \n", "", ".")
    return [
        (conv, k, rng.choice(roles), f"t{rng.randrange(10 * n)}" + rng.choice(ends))
        for k in range(n)
    ]


ODD = [
    (4, None, "user", "a."), (4, None, "assistant", "b."), (4, None, "user", "a."),
    (5, None, None, None), (6, 1, "", ""), (7, 0, "user", "x."), (7, 0, "user", "x."),
    *((8, k, "user", "same.") for k in range(60)), (9, 3, "assistant", "y" * 200_000 + "."),
]
LONG = [
    *conversation(1, 120), *conversation(2, 90, ("user",)), *conversation(None, 70),
    *conversation(3, 5),
]


@pytest.fixture
def turns(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        return df.selectExpr("*", "'x' AS at", "0 AS digest", "1 AS block").repartition(5)

    return make


@pytest.mark.parametrize(
    "options", [{}, {"block_bits": 3, "most_chunks": 5}, {"block_bits": 4}]
)
def test_repairs_match_a_plain_program(turns, options):
    """Also if conversations are cut into many chunks, of which some never converge."""
    got = sorted(map(tuple, cr.repair(turns(LONG + ODD), **options).collect()), key=repr)
    assert got == sorted(plain(LONG + ODD), key=repr)


def test_repairs_match_sql(turns, as_sql):
    df = turns(LONG + ODD).select("conv_id", "turn", "role", "text")
    got = by_name(cr.repair(df, block_bits=4))
    assert got == as_sql(oracle.CONVERSATION_REPAIR, conversations=df)


def test_every_conversation_is_returned(turns):
    rows = [(c, 0, "user", "Hi.") for c in range(60)]  # some lose their only row
    got = {r["conv_id"]: r for r in cr.repair(turns(rows)).collect()}
    gone = [c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert len(got) == 60 and gone
    assert all(got[c]["audit"] == "" and got[c]["cost"] == 0 for c in gone)
    assert cr.repair(turns(rows).where("false")).count() == 0


def test_a_rerun_stops_where_vectors_differ_by_a_constant():
    steps = cr.Steps()
    rng = random.Random(5)
    for _ in range(300):
        codes = "".join(rng.choice("AEIDHLMBF") for _ in range(rng.randrange(1, 60)))
        old, total = steps.run(codes, cr._GUESS)
        for start in (cr._END, (5, 5, 0, 4), (0, 6, 2, 0)):
            assert steps.rerun(codes, cr._GUESS, start, old, total) == steps.run(codes, start)
    # Taking turns brings any two vectors together within a few rows.
    looked_at = []

    class Counting(cr.Steps):
        def before(self, after, code):
            looked_at.append(code)
            return super().before(after, code)

    counting = Counting()
    whole = "EI" * 5000
    first = counting.run(whole, cr._GUESS)
    looked_at.clear()
    assert counting.rerun(whole, cr._GUESS, cr._END, *first) == cr.Steps().run(whole, cr._END)
    assert len(looked_at) < 20


def test_steps_see_few_vectors(turns):
    steps = cr.Steps()
    rng = random.Random(6)
    steps.run("".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(20_000)), cr._END)
    assert len({vector for vector, _ in steps.known}) < 60
