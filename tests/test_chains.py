"""Chains within islands of a hot chat: near copies and anchors against a plain loop."""

import random

from threadline.operators import chunks as ch
from threadline.operators import messages as ms


def test_a_chat_with_most_rows_in_one_island(spark):
    rng = random.Random(2)
    rows, at = [], 0
    for i in range(12_000):
        at += rng.choice([0, 1, 2, 3])
        rows.append((i, rng.choice([7, 7, 7, i % 50]), "assistant", rng.choice(["a", None]), at))
    df = spark.createDataFrame(rows, "msg_id long, chat_id long, type string, message string, at_us long")
    last, want = {}, set()
    for i, chat, _, text, at in rows:
        if (chat, text) not in last or at > last[chat, text] + 50:
            want.add(i)
            last[chat, text] = at
    assert {r.msg_id for r in ms.without_near_copies(df, 50).collect()} == want
    users = spark.createDataFrame([(c, t, 100) for _, c, _, _, t in rows], "chat_id long, at_us long, span long")
    for at_least in (False, True):
        last, anchors = {}, set()
        for _, chat, _, _, at in rows:
            if chat not in last or at - last[chat] > 100 or (at_least and at - last[chat] == 100):
                anchors.add((chat, at))
                last[chat] = at
        got = ch._starts(users, ["chat_id"], "at_us", "span", at_least).collect()
        assert len(got) == len(anchors) and {(r.chat_id, r.at_us) for r in got} == anchors
