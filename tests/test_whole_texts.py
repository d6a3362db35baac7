"""Queries over whole texts against plain Python on small fixtures."""

from collections import Counter

import pytest

from leafmark.plans.layout_queries import QUERIES


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    long = "Où est la bibliothèque? It is there, beneath the old theatre. " * 8
    rows = [(1, 0, long), (1, 1, long + "ß"), (1, 4, long), (2, 2, "naïve é e the"), (2, 3, ""), (None, 0, "the end"), (None, 0, "the end"), (3, 0, None)]
    path = tmp_path_factory.mktemp("turns")
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(f"{path}/conversations.parquet")
    predicted = [None if turn % 5 == 4 or t is None else (t.replace("e", "é") if turn % 2 == 0 else t).replace("th", "h") for _, turn, t in rows]
    return str(path), [(c, turn, t, p) for (c, turn, t), p in zip(rows, predicted)]


def test_error_rates_cover_whole_texts(spark, turns):
    path, rows = turns
    want = [(c, turn, None if t is None else edit_distance(t, p or ""), len(t or "")) for c, turn, t, p in rows]
    got = [tuple(r) for r in QUERIES["character_error_rate"](spark, path).collect()]
    assert sorted(got, key=str) == sorted(((c, turn, e, e / n if n else None) for c, turn, e, n in want), key=str)
    total = QUERIES["micro_macro_cer"](spark, path).first()
    edits, n = sum(e or 0 for *_, e, _ in want), sum(n for *_, n in want)
    assert (total.edits, total.n, total.with_reference, total.missing) == (edits, n, 6, 2) and total.micro == edits / n
    assert total.mean_of_pages == pytest.approx(sum(e / n for *_, e, n in want if n) / 6)


def test_token_bags_cover_whole_texts(spark, turns):
    path, rows = turns
    bags = {}
    for c, turn, t, p in rows:
        r, q = bags.setdefault((c, turn), (Counter(), Counter()))
        r.update((t or "").split())
        q.update((p or "").split())
    want = {}
    for (c, _), (r, q) in bags.items():
        if r or q:
            want[c] = tuple(x + y for x, y in zip(want.get(c, (0, 0, 0)), ((r & q).total(), r.total(), q.total())))
    assert {r.conv_id: tuple(r)[1:] for r in QUERIES["bag_of_tokens"](spark, path).collect()} == want


def test_overlap_is_ranked_by_jaccard(spark, tmp_path):
    item = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(item + [f"long{i}_{j}" for j in range(200)])) for i in range(4)]
    rows += [(9, " ".join([*item[:-1], "other"])), (10, " ".join(item[:22])), (11, "w0 w1 w2")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item[:22]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sets = {k: {tuple(w[i : i + 4]) for i in range(len(w) - 3)} for k, w in [*((d, t.split()) for d, t in rows), ("item", item)]}
    ranked = sorted(((-len(sets[d] & sets["item"]) / len(sets[d] | sets["item"]), -len(sets[d] & sets["item"]), d) for d, _ in rows if len(sets[d]) >= 20))[:3]
    got = QUERIES["page_overlap"](spark, str(tmp_path)).orderBy("item_id", "rank").collect()
    assert [tuple(r) for r in got] == [(1, d, -shared, -j, i + 1) for i, (j, shared, d) in enumerate(ranked)] and got[0].doc_id == 9
