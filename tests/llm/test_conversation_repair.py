import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair
from tidemark.llm.conversation_repair import STATES, cheapest, items_of, lightest, repair_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, name string, pos string, decision string, digest string, block string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables too are dealt over all partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def damage(rows):
    out = {}
    for c, t, role, text in rows:
        n = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{n(c)}:{n(t)}".encode()) % 20
        role, text = n(role), n(text)
        own = out.setdefault(c, [])
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        own += [((t is not None, t or 0), tie, t, role, text)] * (2 if code == 3 else 1)
    return {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = text.rstrip(" \t\n\x0b\x0c\r")
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def edits(rows, wrong):
    """(cost, audit, repaired rows) of the best repair, row by row over the last initial."""
    best = {"": (0, "", ())}

    def offer(to, key, value):
        if key not in to or value[:2] < to[key][:2]:
            to[key] = value

    def insert(at):
        for _ in range(3):
            for key, (cost, audit, done) in list(at.items()):
                role = "assistant" if key == "u" else "user"
                offer(at, role[0], (cost + 5, audit + "I", (*done, (role, ""))))

    insert(best)
    for (_, role, text), fault in zip(rows, wrong):
        following = {}
        for key, (cost, audit, done) in best.items():
            offer(following, key, (cost + 2, audit + "D", done))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            new = "assistant" if key == "u" else "user"
            offer(following, new[0], (cost + 1 + more, audit + "R", (*done, (new, text))))
            if role[:1] == new[0] or (role[:1] == "s" and key == ""):
                offer(following, role[0], (cost + more, audit + "K", (*done, (role, text))))
        best = following
        insert(best)
    return min(best[k] for k in ("", "a") if k in best)


def brute(rows):
    out = []
    for c, own in damage(rows).items():
        wrong = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, done = edits(own, wrong)
        text = "\n".join(f"{role}:{body}" for role, body in done)
        out.append((c, gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def cases():
    rnd = random.Random(12)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No", "Why?", "é!", "", " \n", None, "end. \t", "Yes."]
    rows = [(c, t, rnd.choice(roles[:2] * 4 + roles), rnd.choice(texts) if rnd.random() < 0.4 else f"text {rnd.randrange(50)}.") for c in range(150) for t in range(rnd.randrange(1, 14)) if rnd.random() < 0.9]
    rows += [(200, None, "user", "a."), (200, None, "user", "a."), (200, 3, "user", "b."), (200, 3, "assistant", "c."), (None, None, "system", "d."), (None, 2, "user", "e")]
    rows += [(201, None, "user", "a.")] + [(c, 0, "user", "x.") for c in range(300, 340)]
    rows += [(400, t // 2, "user" if t % 5 else "system", f"text {t % 900}" + "." * (t % 7 > 0)) for t in range(3000)]
    rnd.shuffle(rows)
    return rows


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(6)
    return sorted(map(tuple, repair_conversations(docs).collect()), key=repr)


def test_repairs_equal_brute_force(spark):
    rows = cases()
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_dropped_rows(spark):
    assert found(spark, []) == []
    gone = next((c, 0, "user", "x.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [gone]) == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] == brute([gone])


def test_least_of_all_edits():
    rnd, words = random.Random(2), ["", "u", "a", "ua", "au"]
    for _ in range(25):
        rows = "".join(rnd.choice("suaoSUAOx") for _ in range(rnd.randrange(0, 4)))
        best = None
        choices = [[("D", 2, "")] + ([] if x == "x" else [(e, c + 5 * x.isupper(), r) for e, c, r in (("K", 0, x.lower()), ("R", 1, "u"), ("R", 1, "a"))]) for x in rows]
        for gaps in itertools.product(words, repeat=len(rows) + 1):
            for made in itertools.product(*choices):
                roles = gaps[0] + "".join(r + g for (_, _, r), g in zip(made, gaps[1:]))
                if re.fullmatch("(s?(ua)+)?", roles):
                    cost = 5 * sum(map(len, gaps)) + sum(c for _, c, _ in made)
                    audit = "I" * len(gaps[0]) + "".join(e + "I" * len(g) for (e, _, _), g in zip(made, gaps[1:]))
                    best = min(best, (cost, audit)) if best else (cost, audit)
        assert cheapest([items_of(rows, (0,))]) == best


def test_pieces_compose(monkeypatch):
    rnd = random.Random(6)
    rows = "".join(rnd.choice("suaaauuuoUAx") for _ in range(700))
    whole = cheapest([items_of(rows, (0,))])
    for size, joined in ((1, 2), (3, 2), (50, 3), (1000, 16)):
        monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", size)
        monkeypatch.setattr(conversation_repair, "JOINED", joined)
        assert cheapest([items_of(rows, (0,))]) == whole
        cuts = sorted(rnd.sample(range(1, 700), 5))
        pieces = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 700])]
        assert cheapest([items_of(p, STATES) for p in pieces]) == whole


def test_agenda_finalises_least_values():
    edges = {"a": [("b", 4, "x"), ("c", 1, "y")], "c": [("b", 1, "z"), ("d", 9, "w")], "b": [("d", 1, "v")]}
    final = lightest([("a", (0, ""))], lambda i, v: [(t, (v[0] + c, v[1] + s)) for t, c, s in edges.get(i, [])], "d")
    assert final == {"a": (0, ""), "c": (1, "y"), "b": (2, "yz"), "d": (3, "yzv")}


def test_long_conversation_is_spread(spark):
    docs = spark.createDataFrame([(1, t, "user", f"{t}.") for t in range(4000)], "conv_id bigint, turn bigint, role string, text string")
    rows = conversation_repair._rows(conversation_repair.damaged(docs))
    assert rows.select(F.countDistinct("block")).first()[0] > 1
