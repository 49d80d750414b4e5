"""The cost of repaired chats against all choices of roles."""

import random
from itertools import product

from nearstop.llm import chat

ROLES = ("system", "user", "assistant")
#: Empty turns that a role needs before it, by the role before; what is missing cannot follow.
NEEDED = {
    (None, "system"): 0, (None, "user"): 0, (None, "assistant"): 1,
    ("system", "system"): 0, ("system", "user"): 0, ("system", "assistant"): 1,
    ("user", "user"): 0, ("user", "assistant"): 0,
    ("assistant", "user"): 0, ("assistant", "assistant"): 0,
}
AT_END = {"system": 2, "user": 1, "assistant": 0}


def least_cost(given):
    best = float("inf")
    for chosen in product(ROLES, repeat=len(given)):
        cost, before = 0.0, None
        for role, was in zip(chosen, given, strict=True):
            if (before, role) not in NEEDED:
                break
            cost += 2.0 * NEEDED[before, role] + (1.0 if role == before else 0.0)
            if role != was:
                cost += 3.0 if was in ROLES else 1.5
            before = role
        else:
            best = min(best, cost + 2.0 * AT_END[before])
    return best


def test_cost_is_the_least_of_all(spark):
    chance = random.Random(3)
    chats = [
        [chance.choice([*ROLES, "user", "assistant", None, "tool"]) for _ in range(chance.randrange(1, 7))]
        for _ in range(200)
    ]
    rows = [(c, n, role, f"t{n}") for c, roles in enumerate(chats) for n, role in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {}
    for r in chat.repair_chats(df).collect():
        found.setdefault(r.conv_id, []).append((r.place, r.new_role, r.total_cost))
    for c, roles in enumerate(chats):
        assert len(found[c]) == len(roles) and {x[2] for x in found[c]} == {least_cost(roles)}
        # The repaired roles are legal by themselves: what they cost is the merges and empty turns.
        new = [role for _, role, _ in sorted(found[c])]
        changed = sum(
            (3.0 if was in ROLES else 1.5) for role, was in zip(new, roles, strict=True) if role != was
        )
        assert least_cost(new) + changed == found[c][0][2]
