import hashlib

from helpers import awkward, frame, prose, row, with_clashes

from waterline.llm.sharding import SLACK, byte_shards


def brute(docs, n):
    size = lambda t: len((t or "").encode()) + 1
    laid = sorted(docs, key=lambda d: (hashlib.md5((d[1] or "").encode()).hexdigest(), d[0] is not None, d[0] or 0))
    total = sum(size(t) for _, t in laid)
    starts, at = [], 0
    for _, t in laid:
        starts.append(at)
        at += size(t)
    cuts = []
    for k in range(1, n):
        target = -(-k * total // n)
        j = next((j for j, (_, t) in enumerate(laid) if starts[j] < target <= starts[j] + size(t)), None)
        if j is None:
            continue
        same = [i for i, (_, t) in enumerate(laid) if (t or "") == (laid[j][1] or "")]
        whole = sum(size(laid[i][1]) for i in same)
        end = starts[j] + size(laid[j][1])
        cuts.append(starts[same[0]] if whole <= SLACK * total / n and starts[same[0]] + whole > end else end)
    shards = [sum(c <= s for c in cuts) for s in starts]
    return sorted((i if i is not None else -1, t or "", s, shards[:j].count(s)) for j, ((i, t), s) in enumerate(zip(laid, shards, strict=True)))


def test_equals_brute_force(spark):
    docs = [(k, " ".join(prose(k % 400, 5 + k % 37))) for k in range(600)] + [(None, None), (9001, ""), (9002, None)]
    got = byte_shards(frame(spark, [row(i, t) for i, t in docs]), 5, parts=7).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.shard, r.slot) for r in got) == brute(docs, 5)
    sums = [sum(r.size for r in got if r.shard == k) for k in range(5)]
    assert max(sums) - min(sums) < 0.05 * max(sums)


def test_a_huge_group_is_cut_and_a_small_one_is_not(spark):
    docs = [(k, "the same text") for k in range(3000)] + [(5000 + k, f"own {k}") for k in range(3000)]
    got = byte_shards(frame(spark, [row(i, t) for i, t in docs]), 8).collect()
    sums = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert max(sums) - min(sums) <= 2 * len("the same text ") and len({r.shard for r in got if r.text == "the same text"}) > 1


def test_awkward_rows_and_columns(spark):
    df = with_clashes(awkward(spark))
    got = byte_shards(df, 3)
    assert set(got.columns) == set(df.columns) - {"_piece"} and got.count() == 14
    rows = got.collect()
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(3))
    assert byte_shards(frame(spark, []), 3).count() == 0 and [r.shard for r in byte_shards(frame(spark, [row(1, "x")]), 4).collect()] == [0]
