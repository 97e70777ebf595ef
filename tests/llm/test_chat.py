import random
from collections import defaultdict
from functools import lru_cache

from grainstone.llm import chat

AFTER = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def brute(roles):
    """Least cost by trying everything, in terms of names and independent of the tables."""

    @lru_cache(None)
    def go(i, last):
        if i == len(roles):
            return {"": 0, "system": 6, "user": 3, "assistant": 0}[last]
        best = 10**9
        for new in ("system", "user", "assistant"):
            cost = 0 if new == roles[i] else 2
            if new == last:
                best = min(best, cost + 1 + go(i + 1, new))
            if new in AFTER[last]:
                best = min(best, cost + go(i + 1, new))
            for empty in AFTER[last]:
                if new in AFTER[empty]:
                    best = min(best, cost + 3 + go(i + 1, new))
        return best

    return go(0, "")


def parsed(text):
    out = []
    while text:
        head, _, rest = text.partition("\n")
        body, _, text = rest.partition("<|end|>\n")
        out.append((head[2:-2], body))
    return out


def test_repairs_are_cheapest_and_legal(spark):
    rng = random.Random(6)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["system", "user", "assistant", "User", "tool", None]), f"c{c} t{t}"))
    rows += [(900, t, rng.choice(["user", "user", "assistant", "system"]), f"x{t}") for t in range(700)]
    rows += [(None, 0, "user", None), (None, 1, "assistant", ""), (901, 5, "user", "same"), (901, 5, "user", "same"), (901, 5, "user", "other"), (901, None, "user", "n")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, copies int, h string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = chat.repair(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r.copies for r in out) == len(rows) and len(out) == len(set(rows))
    chats = defaultdict(list)
    for r in out:  # collected in the order of the ranges
        chats[r.conv_id].append(r)
    for turns in chats.values():
        roles = tuple((r.role or "").lower() for r in turns)
        assert sum(r.cost for r in turns) == brute(roles)
        said = parsed("".join(r.rendered for r in turns))
        last = ""
        for role, _ in said:
            assert role in AFTER[last]
            last = role
        assert last == "assistant"
        kept = "".join(body for _, body in said).replace("\n", "")
        assert kept == "".join(next(x[3] for x in rows if (x[0], x[1], x[2]) == (r.conv_id, r.turn, r.role) and (r.conv_id != 901 or r.turn is None or (x[3] or "") in r.rendered)) or "" for r in turns)


def test_no_turns(spark):
    assert chat.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
