"""Small literal cases and brute force for the operators."""

import itertools
import random

import numpy as np

from threadline.functions import text as fx
from threadline.operators import chunks as ch
from threadline.operators import cluster as cl
from threadline.operators import fuzzy as fz
from threadline.operators import matching as mt
from threadline.operators import messages as ms
from threadline.operators import responses as rs
from threadline.operators import segments as sg
from threadline.operators import signals as sn
from threadline.operators import tables as tb

S, MIN, H, D = ms.SECOND, ms.MINUTE, ms.HOUR, ms.DAY
DDL = "msg_id long, chat_id long, user_id long, type string, message string, at_us long"


def rows(spark, items):
    return spark.createDataFrame([(i, 1, 1, kind, text, at) for i, (kind, text, at) in enumerate(items)], DDL)


def walk(items, gap, window, reply):
    """Chunks step by step: (chunk number, kind) per row of one chat, in time order."""
    out, i, number, prior = {}, 0, 0, None
    order = sorted(range(len(items)), key=lambda j: (items[j][1], j))
    covered = set()
    while i < len(order):
        j = order[i]
        kind, at = items[j]
        if j in covered:
            i += 1
            continue
        if kind == "user":
            inside = [x for x in order[i:] if items[x][1] - at <= window]
            users = [items[x][1] for x in inside if items[x][0] == "user"]
            last = max(users)
            taken = inside if last == at else [x for x in inside if items[x][1] <= last or items[x][1] - last <= reply]
            number += 1
            for x in taken:
                out[x] = (number, "user_engaged")
            covered |= set(taken)
            prior = None
        else:
            if prior is None or at - prior > gap:
                number += 1
            out[j] = (number, "bot_only")
            prior = at
        i += 1
    return out


def test_chunks_equal_a_step_walk(spark):
    rng = random.Random(1)
    chats = []
    for _ in range(40):
        at, items = 0, []
        for _ in range(rng.randint(1, 25)):
            at += rng.choice([0, 30 * S, 60 * S, 61 * S, 59 * MIN, H, H + 1, D, 3 * D])
            items.append((rng.choice(["user", "assistant", "automated"]), at))
        chats.append(items)
    data = [(c * 1000 + i, c, c, kind, "x", at) for c, items in enumerate(chats) for i, (kind, at) in enumerate(items)]
    got = {(r.chat_id, r.msg_id % 1000): (r.chunk_no, r.kind) for r in ch.chunks(spark.createDataFrame(data, DDL)).collect()}
    for c, items in enumerate(chats):
        assert {i: got[c, i] for i in range(len(items))} == walk(items, MIN, 3 * D, H), items


def test_chunk_edges(spark):
    got = ch.chunks(rows(spark, [("assistant", "a", 0), ("assistant", "b", 60 * S), ("assistant", "c", 121 * S)]))
    assert [r.chunk_no for r in got.orderBy("msg_id").collect()] == [1, 1, 2]
    got = ch.chunks(rows(spark, [("user", "a", 0), ("assistant", None, None), ("user", "b", 3 * D), ("user", "c", 3 * D + 1)]))
    assert [(r.chunk_no, r.kind) for r in got.orderBy("msg_id").collect()] == [(1, "user_engaged")] * 3 + [(2, "user_engaged")]
    assert ch.chunks(rows(spark, [("user", "a", 0)]).where("false")).count() == 0


def test_near_copies(spark):
    items = [("assistant", "x", 0), ("team", "x", 2 * S), ("assistant", "x", 3 * S), ("assistant", "x", 5 * S), ("user", "x", 5 * S), ("user", "x", 5 * S), ("assistant", None, 0), ("assistant", None, S), ("assistant", "x", None)]
    kept = {r.msg_id for r in ms.without_near_copies(rows(spark, items)).collect()}
    assert kept == {0, 2, 4, 5, 6, 8}


def test_unanswered(spark):
    items = [("user", "hi", 1), ("user", "Liked your note", 2), ("system", "other", 3), ("user", "again", 4), ("system", "[Tool Call] noReply", 5), ("user", "end", 6)]
    assert {r.msg_id for r in ms.unanswered(rows(spark, items)).where("unanswered").collect()} == {0, 5}


def test_windows(spark):
    items = [("user", "a", 0), ("assistant", "b", 1), ("assistant", "c", 2), ("assistant", "d", 3), ("user", "e", 4), ("assistant", "f", 5)]
    assert [r.window_no for r in ch.windows(rows(spark, items), 3).orderBy("pos").collect()] == [0, 0, 0, 0, 1, 1]
    assert [r.window_no for r in ch.windows(rows(spark, items), 0).orderBy("pos").collect()] == [0] * 6


def test_images(spark):
    image = "https://storage.googleapis.com/a.png"
    items = [("assistant", image, 0), ("assistant", image, 1), ("user", image, 2), ("assistant", f"[media: {image}]", 3), ("assistant", "text", 4)]
    got = ch.merge_images(ch.windows(rows(spark, items), 0)).orderBy("new_pos").collect()
    assert [(r.msg_id, r.text) for r in got] == [(0, "[image] [image]"), (2, f"{image} [image]"), (4, "text")]


def test_texts(spark):
    f = spark.createDataFrame([(" Match-Feed  back__",), ("https://youtu.be/x see",), ("[media: https://firebasestorage.googleapis.com/a.VCF]",), ("NOTE: User uploaded 3 image(s). User Message: look Image URL: https://x.y",), (None,)], "t string")
    got = f.select(fx.slug(f.t), fx.replace_urls(f.t), fx.clean_upload(f.t)).collect()
    assert got[0][0] == "match_feed_back" and got[1][1] == "[youtube link] see" and got[2][1] == "[contact card]"
    assert got[3][2] == 'User uploaded 3 image(s): "look" [image]' and got[4] == (None, None, None)


def test_responses(spark):
    item = '{"topic": "t", "subTopic": "s", "summary": "x", "messageIndices": [0, 1.7, "2", 9, -1, "z"], "confidence": %s}'
    texts = ["no braces", '{"segments": [', '{"a": 1}', '```json\n{"segments": [%s, 5, {"topic": "t"}]}\n```' % (item % "1.5"), '{"segments": [%s]}' % (item % '"bad"'), None]
    got = rs.parsed(spark.createDataFrame([(i, 3, t) for i, t in enumerate(texts)], "window_id long, n_msgs int, response string")).orderBy("window_id", "item_no").collect()
    assert [(r.window_id, r.item_no, r.reason) for r in got] == [(0, -1, "no object"), (1, -1, "no object"), (2, -1, "no list"), (3, 0, None), (3, 1, "not an object"), (3, 2, "missing field"), (4, 0, None), (5, -1, "no object")]
    assert got[3].indices == [0, 1, 2] and got[3].confidence == 0.99 and got[3].sentiment is None and got[6].confidence == 0.0


def test_owner_and_orphans(spark):
    data = [(1, 1, "assistant", 0, 0), (1, 2, "assistant", 1, 0), (1, 2, "assistant", 1, 1), (1, 3, "user", 2, 0), (1, 3, "user", 2, 1)]
    got = sg.one_owner(spark.createDataFrame(data, "window_id long, msg_id long, type string, pos long, segment_no long"))
    assert sorted((r.msg_id, r.segment_no) for r in got.collect()) == [(1, 0), (2, 0), (3, 0), (3, 1)]
    members = spark.createDataFrame([(1, 2, 5), (1, 5, 3)], "window_id long, pos long, segment_no long")
    got = sg.with_orphans(members, spark.createDataFrame([(1, i) for i in range(7)], "window_id long, pos long"))
    assert [r.segment_no for r in got.orderBy("pos").collect()] == [5, 5, 5, 5, 3, 3, 3]


def test_assignment_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, m = rng.integers(1, 6, 2).tolist()
        score = np.where(rng.random((n, m)) < 0.3, 0, rng.random((n, m)))
        best = max(sum(score[i, j] for i, j in zip(a, b, strict=True)) for k in [min(n, m)] for a in itertools.combinations(range(n), k) for b in itertools.permutations(range(m), k))
        pairs = mt.assign(score)
        assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        assert abs(sum(score[i, j] for i, j in pairs) - best) < 1e-9


def test_optimal_matching(spark):
    rng = np.random.default_rng(3)
    data, best = [], {}
    for user in range(30):
        n, m = rng.integers(1, 5, 2).tolist()
        score = np.where(rng.random((n, m)) < 0.5, 0, rng.uniform(0.3, 1, (n, m)))
        data += [(1, user, user * 10 + int(i), user * 10 + int(j), float(score[i, j])) for i in range(n) for j in range(m) if score[i, j]]
        best[user] = sum(score[i, j] for i, j in mt.assign(score))
    got = mt.optimal(spark.createDataFrame(data, "run_id int, user_id long, gt_id long, model_id long, score double")).collect()
    assert len({r.gt_id for r in got}) == len({r.model_id for r in got}) == len(got)
    for user, total in best.items():
        assert abs(sum(r.score for r in got if r.user_id == user) - total) < 1e-9


def test_signals(spark):
    data = [(1, [1, 2], "ContactExchanged", None), (2, [1, 2], "Failed - Refused", ["accepted", "rejected"]), (3, [1, 2], "Failed - Refused", ["accepted"]), (4, [1], "ContactExchanged", []), (5, [1, 2], "Open", []), (6, [1, 2], "Failed - Refused", ["rejected"])]
    got = sn.classify(spark.createDataFrame(data, "matching_id long, users array<long>, status string, acceptance array<string>"))
    assert {r.matching_id: r.signal for r in got.collect()} == {1: ["TP", "TP"], 2: ["TP", "FP"], 6: ["FP", "FP"]}


def test_tables(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, v string, by string")
    new = spark.createDataFrame([(2, "c", "z"), (3, None, "z")], "id long, v string, by string")
    assert sorted(map(tuple, tb.upsert(old, new, ["id"], ["by"]).collect())) == [(1, "a", "x"), (2, "c", "y"), (3, None, "z")]
    assert sorted(r.id for r in tb.insert_missing(old, new, ["id"]).collect()) == [1, 2, 3]
    path = str(tmp_path / "t")
    tb.replace_partition(old, path, "by")
    tb.replace_partition(old.where("id = 1").selectExpr("id", "'new' AS v", "by"), path, "by")
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "new"), (2, "b")]


def test_template_ratio(spark):
    messages = spark.createDataFrame([("automated", "Hello Anna, welcome"), ("user", "Hello Bob, welcome"), ("automated", ""), ("automated", "zzz")], "type string, message string")
    templates = spark.createDataFrame([(2, "Hello Marta, welcome"), (1, "Hello Marta, welcome"), (3, "other")], "template_id long, template string")
    got = fz.template_matches(messages, templates).collect()
    assert [(r.message, r.template_id) for r in got] == [("Hello Anna, welcome", 1)] and got[0].ratio > 0.75


def test_density(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(3, 8)) * 5
    x = np.vstack([*(c + rng.normal(size=(20, 8)) * 0.1 for c in centers), rng.normal(size=(2, 8)) @ np.diag([9, -9] * 4)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for blocks in (1, 3):
        got = {r.vec_id: (r.cluster, r.membership) for r in cl.density(df, k=4, eps=0.05, blocks=blocks).collect()}
        assert [got[i][0] for i in range(60)] == [0] * 20 + [20] * 20 + [40] * 20
        assert all(0 <= m <= 1 for _, m in got.values())


def test_template_ratio_of_whole_texts(spark):
    """The best template by whole texts, as difflib finds it over all pairs; a shared first sentence is not enough."""
    from difflib import SequenceMatcher

    rng = np.random.default_rng(5)
    words = ["of", "the", "and", "ing", "tion", "re", "Qu", "x", "ou", "ê", ",", "z.\n"]
    prose = lambda n: " ".join(rng.choice(words, n))

    def changed(t, p):
        return "".join(c if rng.random() > p else "k" for c in t)

    templates = [prose(n) for n in (10, 20, 30, 45, 60, 60, 80, 150, 250, 400)] + ["Same start. " + prose(60), "no full stop at all here", "x" * 300, None, ""]
    messages = [changed(t, p) for t in templates[:10] for p in (0, 0.02, 0.05, 0.1, 0.3)] + [prose(n) for n in (15, 70, 200)]
    messages += ["Same start. " + "other words entirely! " * 12, "no full stop at all there", "x" * 300, templates[8][:700] + templates[9][700:]]
    want = {}
    for m in messages:
        r, i = max((SequenceMatcher(None, m, t).ratio(), -i) for i, t in enumerate(templates) if t)
        if r >= 0.75:
            want[m] = (-i, r)
    rows = spark.createDataFrame([("automated", m) for m in messages], "type string, message string")
    known = spark.createDataFrame(list(enumerate(templates)), "template_id long, template string")
    got = {r.message: (r.template_id, r.ratio) for r in fz.template_matches(rows, known).collect()}
    assert got == want and 20 < len(want) < len(set(messages)) and got["no full stop at all there"][0] == 11
    again = fz.template_matches(rows, known, block=3)
    assert {r.message: (r.template_id, r.ratio) for r in again.collect()} == want


def test_neighbours_by_cosine_equal_all_pairs(spark):
    """Equal vectors, a large norm, ties to the smaller id; a few thousand vectors are several tasks, and a pair has one cosine."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(4000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:400] = x[7]
    x[5] *= 1e17
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    blocks = cl.blocks_for(df, 20_000)
    assert blocks == 4
    got = {}
    for r in cl.neighbours(df, 3, blocks).collect():
        got.setdefault(r.query, {})[r["rank"]] = (r.vec_id, r.cosine)
    for q in [*range(0, 4000, 37), 5, 7, 100, 399]:
        s = (x * x[q]).sum(axis=1)
        order = [int(j) for j in np.lexsort((np.arange(4000), -s)) if j != q][:3]
        assert [got[q][i + 1] for i in range(3)] == [(j, float(s[j])) for j in order]


def test_density_of_a_long_chain(spark):
    """A chain of neighbours in random order, with many local minima and a long diameter, is one cluster."""
    n, step = 300, np.pi / 300
    ids = np.random.default_rng(12).permutation(n).tolist()
    df = spark.createDataFrame([(i, [float(np.cos(j * step)), float(np.sin(j * step))]) for j, i in enumerate(ids)], "vec_id long, embedding array<double>")
    assert {r.cluster for r in cl.density(df, k=2, eps=float(1 - np.cos(2.5 * step)), blocks=1).collect()} == {0}


def test_runs_at_once_equal_runs_alone(spark):
    rng, data = random.Random(6), []
    for c in range(8):
        at = 0
        for i in range(20):
            at += rng.choice([30 * S, 61 * S, H, D, 2 * D, 3 * D])
            data.append((c * 100 + i, c, c, rng.choice(["user", "assistant"]), "x", at))
    df = spark.createDataFrame(data, DDL)
    runs = {1: (MIN, 3 * D), 2: (2 * D, D)}
    both = df.crossJoin(spark.createDataFrame([(r, g, w) for r, (g, w) in runs.items()], "run_id int, gap long, span long"))
    from pyspark.sql import functions as F

    got = {(r.run_id, r.msg_id): (r.chunk_no, r.kind) for r in ch.chunks(both, F.col("gap"), F.col("span"), H, "run_id").collect()}
    for run, (gap, window) in runs.items():
        assert {r.msg_id: (r.chunk_no, r.kind) for r in ch.chunks(df, gap, window, H).collect()} == {m: v for (r, m), v in got.items() if r == run}


def test_optimal_matching_by_component(spark):
    """Users with many entangled pairs are solved component by component, with the same total."""
    rng, data = np.random.default_rng(9), []
    for part in range(12):
        score = rng.uniform(0.3, 1, (3, 3))
        data += [(1, part % 2, part * 10 + i, part * 10 + j, float(score[i, j])) for i in range(3) for j in range(3)]
    df = spark.createDataFrame(data, "run_id int, user_id long, gt_id long, model_id long, score double")
    plain, parted = (sorted(map(tuple, mt.optimal(df, most=most).collect())) for most in (20_000, 10))
    assert plain == parted and len(plain) == 36


def test_closest_and_validated_labels(spark):
    """The closest slugs are those of difflib over all pairs of a topic; remapping takes each of its ways."""
    from difflib import SequenceMatcher

    rng = random.Random(2)
    word = lambda: "_".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(1, 3)))
    known, names = [(t, word()) for t in "xy" for _ in range(25)], [(t, word()) for t in "xyz" for _ in range(25)]
    got = {(r.topic, r.sub_topic): (r.known, r.similarity) for r in fz.closest(spark.createDataFrame(names, "topic string, sub_topic string"), spark.createDataFrame(known, "topic string, sub_topic string")).collect()}
    want = {}
    for t, n in names:
        rated = sorted((-SequenceMatcher(None, n, k).ratio(), k) for u, k in known if u == t)
        if rated and -rated[0][0] >= 0.5:
            want[t, n] = (rated[0][1], -rated[0][0])
    assert got == want and want
    rows = [(1, 7, "x", "match_feedback"), (2, 7, "x", "match_feedback_new"), (3, 7, "x", "e_match_feedback"), (4, 7, "x", "match_feedbacks_soon"), (5, 8, "x", "date_plan_ideas_asked"), (6, 9, "x", "date_plan_ideas_asked"), (7, 7, "x", "qqq")]
    known = [("x", "match_feedback"), ("x", "date_plan_idea_given")]
    got = fz.validated(spark.createDataFrame(rows, "id int, user_id int, topic string, sub_topic string"), spark.createDataFrame(known, "topic string, sub_topic string"), spark.createDataFrame([(8, "date_plan_idea_given")], "user_id int, sub_topic string"))
    got = {r.id: (r.valid, r.how) for r in got.collect()}
    assert got[1] == ("match_feedback", "known") and got[2] == got[3] == ("match_feedback", "variant") and got[4] == ("match_feedbacks_soon", "kept")
    assert got[5] == ("date_plan_idea_given", "truth") and got[6] == ("date_plan_ideas_asked", "kept") and got[7] == ("qqq", "kept")


def test_reads_of_the_store(spark):
    import pytest

    rows = spark.createDataFrame([(1, 1, "a", None, None, 5), (2, 1, "b", "t", "s", 3), (3, 2, None, None, None, None)], "segment_id int, user_id int, topic string, true_topic string, true_sub_topic string, started_at long")
    assert [r.segment_id for r in tb.filtered(rows, {"topic"}, topic=None).collect()] == [3]
    with pytest.raises(ValueError):
        tb.filtered(rows, {"topic"}, user_id=1)
    with pytest.raises(ValueError):
        tb.ground_truth(rows.where("segment_id = 1"))
    assert [(r.segment_id, r.nth) for r in tb.of_users(rows).orderBy("user_id", "nth").collect()] == [(2, 1), (1, 2), (3, 1)]
    assert [r.segment_id for r in tb.of_users(rows, True).collect()] == [2] and tb.of_users(rows, None, 1).count() == 2
    assert tb.fingerprint(rows, "segment_id").first() == tb.fingerprint(rows.repartition(3), "segment_id").first()
    new = tb.update(rows, spark.createDataFrame([(3, "c")], "segment_id int, topic string"), "segment_id", "topic")
    assert {r.segment_id: r.topic for r in new.collect()} == {1: "a", 2: "b", 3: "c"}


def test_matrix_free_cluster_measures(spark):
    """Silhouette and own distance equal their definitions over all pairs."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.r_[np.zeros(12, int), np.ones(17, int), 2]
    df = spark.createDataFrame([(i, int(label[i]), v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, embedding array<double>")
    d = 1 - x @ x.T
    scores = []
    for i in range(30):
        same = (label == label[i]) & (np.arange(30) != i)
        b = min(d[i, label == g].mean() for g in set(label) - {label[i]})
        scores.append((b - d[i, same].mean()) / max(b, d[i, same].mean()) if same.any() else 0.0)
    assert abs(cl.silhouette(df, "label").first().silhouette - np.mean(scores)) < 1e-9
    for r in cl.own_distance(df, "label").collect():
        c = x[label == r.label].mean(axis=0)
        assert abs(r.distance - np.mean(1 - x[label == r.label] @ c / np.linalg.norm(c))) < 1e-9
    parts = {r.vec_id: r.components for r in cl.reduced(df, 2).collect()}
    got = np.array([parts[i] for i in range(30)])
    u = np.linalg.svd(x - x.mean(axis=0))[2][:2]
    assert np.allclose(np.abs(got), np.abs(x @ u.T), atol=1e-8)
