"""Repair of conversations against a row-by-row search over all edits."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cohortloom.llm import grammar, queries, repair
from tests.llm.conftest import LARGER

SPACE = " \t\n\x0b\x0c\r"
NEXT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
NAMES = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string"


def with_inserts(best):
    best = dict(best)
    for _ in range(4):
        for state, (cost, audit, lines) in list(best.items()):
            for x in "ua":
                after, made = NEXT.get((state, x)), (cost + 2, audit + "I", (*lines, NAMES[x] + ":"))
                if after and (after not in best or made[:2] < best[after][:2]):
                    best[after] = made
    return best


def cheapest(rows):
    """(cost, audit, lines) of (initial, mark, role, text) rows; whole texts are carried along."""
    best = {"E": (0, "", ())}
    for initial, mark, role, text in rows:
        made = defaultdict(list)
        for state, (cost, audit, lines) in with_inserts(best).items():
            made[state].append((cost + 3, audit + "D", lines))
            if mark == "!":
                continue
            more = cost + (mark == "~")
            if (state, initial) in NEXT:
                made[NEXT[state, initial]].append((more, audit + "K", (*lines, f"{role}:{text}")))
            for x in "ua":
                if (state, x) in NEXT:
                    made[NEXT[state, x]].append((more + 2, audit + "R", (*lines, f"{NAMES[x]}:{text}")))
        best = {state: min(found) for state, found in made.items()}
    best = with_inserts(best)
    return min(best[s] for s in "EA" if s in best)


def expected(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = conversations[conv]
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if case == 1 else "".join(c for c in text if c not in ".!?") if case == 2 else text
        role = "user" if case == 4 else role
        kept += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    out = {}
    for conv, kept in conversations.items():
        kept.sort(key=lambda r: (
            r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
        ))
        seen, marked, faults = set(), [], defaultdict(int)
        for _, role, text in kept:
            content = text.strip(SPACE)
            fault = "blank" if not content else "duplicate" if (role, text) in seen else ""
            fault = fault or ("" if content[-1] in ".!?" else "truncated")
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role[:1], {"": "", "truncated": "~"}.get(fault, "!"), role, text))
        cost, audit, lines = cheapest(marked)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)
    return out


def check(found, rows):
    want = expected(rows)
    assert {r["conv"] for r in found} == set(want) and len(found) == len(want)
    for r in found:
        assert tuple(r)[1:] == want[r["conv"]]


def test_automaton_has_few_stacks():
    parser = grammar.Parser()
    assert parser.stacks == 8
    with pytest.raises(ValueError):
        grammar.Automaton((("C", ("(", "C", ")")), ("C", ())))


def test_parser_and_pieces():
    parser, rng = grammar.Parser(), random.Random(1)
    for _ in range(2000):
        alphabet = "suax"[: rng.choice([2, 3, 4])]
        symbols = [rng.choice(alphabet) + rng.choice(["", "", "!", "~"]) for _ in range(rng.randrange(14))]
        cost, audit, _ = cheapest([(s[0], s[1:], "", "") for s in symbols])
        frontier, total, back = parser.run(symbols)
        more, place, last = parser.accept(frontier)
        edits = [*parser.edits(back, place), last]
        assert (total + more, "".join(e for row in edits for e, _ in row)) == (cost, audit)
        cuts = sorted(rng.randrange(len(symbols) + 1) for _ in range(3))
        pieces = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        frontier, total, history = ((0, 0),), 0, []
        for piece in pieces:
            frontier, more, links = parser.join(frontier, parser.summary(piece))
            total += more
            history.append(links)
        more, place, last = parser.accept(frontier)
        ends = []
        for links in reversed(history):
            place, end = links[place]
            ends.append(end)
        begin, letters = 0, ""
        for piece, end in zip(pieces, reversed(ends)):
            tops, _, back = parser.run(piece, begin)
            way = parser.edits(back, [stack for stack, _ in tops].index(end))
            letters, begin = letters + "".join(e for row in way for e, _ in row), end
        assert (total + more, letters + "".join(e for e, _ in last)) == (cost, audit)


def awkward():
    rng = random.Random(3)
    texts = [None, "", " \t", "ok.", "a b c", "done!", "hm? ", "x" * 50_000 + ".", *[f"t{i}." for i in range(30)]]
    roles = [None, "system", "user", "assistant", "user", "assistant", "tool", ""]
    rows = [
        (conv, rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts))
        for conv in [None, *range(8)] for _ in range(rng.choice([1, 3, 60]))
    ]
    rows += [
        (77, k // 2, rng.choice(["system", "user", "assistant", "user", "assistant"]), rng.choice(["ok.", f"t{k}.", "", "x"]))
        for k in range(1500)
    ]  # one long conversation
    rows += [(78, 3, "user", "same.")] * 300 + [(79, None, None, None)] * 5
    dropped = next(t for t in range(10_000) if zlib.crc32(f"80:{t}".encode()) % 20 == 0)
    return rows + [(80, dropped, "user", "gone.")]


@pytest.mark.parametrize("piece", [30, 1000, repair.PIECE])
def test_conversations_over_tasks_and_pieces(spark, piece):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = repair.repair(repair.damaged(df), piece).collect()
    check(found, rows)
    nothing = next(r for r in found if r["conv"] == 80)
    assert tuple(nothing)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damaged(empty)).collect() == []
    more = "conv string, present string, kind string, at string, digest string, unit string, copy string"
    df = spark.createDataFrame([(1, 0, "user", "Hi?", *["c"] * 7), (1, 1, "assistant", "Yes.", *["c"] * 7)], f"{SCHEMA}, {more}")
    check(repair.repair(repair.damaged(df)).collect(), [(1, 0, "user", "Hi?"), (1, 1, "assistant", "Yes.")])


@pytest.mark.given
def test_op11(spark):
    found = queries.op11_glr_repair(spark, LARGER).withColumnRenamed("conv_id", "conv").collect()
    rows = spark.read.parquet(f"{LARGER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    check(found, [tuple(r) for r in rows])
