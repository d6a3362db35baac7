"""The operators against plain Python versions, and with columns whose names clash with their own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmark.llm import chat, common, decontaminate, language, mixing, near_dup, pii, sharding, token_records, top_k

CLASHES = "score accepted lang_pred languages size source_size key level bits rid tie target copies copy shard slot base spans found row mark least place id part edge _text hit".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(7)
    letters = {"aa": "abcdeo", "bb": "fghijo", "cc": "klmnou"}
    rows = []
    for i in range(90):
        lang = ["aa", "bb", "cc"][i % 3]
        words = ["".join(rng.choice(list(letters[lang]), 4)) for _ in range(8 + i % 40)]
        rows.append((i, " ".join(words), lang if i % 4 else None, f"s{i % 5}" if i % 9 else None))
    rows += [(90, rows[3][1], "aa", "s1"), (91, rows[4][1] + " oo", "bb", "s0"), (92, None, "aa", "s1"), (93, "", None, "s2"), (94, "12 + 3", "bb", None), (95, rows[5][1], "cc", "s2"), (96, "x " + rows[7][1], "bb", "s4")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def crowded(corpus):
    return corpus.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in CLASHES])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def bench_dir(spark, corpus, tmp_path_factory):
    path = tmp_path_factory.mktemp("bench")
    text = corpus.where("doc_id = 13").first().text.upper()
    spark.createDataFrame([(1, text), (2, None), (3, "no such words in any document of this table at all")], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


@pytest.mark.parametrize("number", range(5))
def test_stages_keep_clashing_columns(spark, crowded, bench_dir, number):
    name, stage = corpus_pipeline.STAGES[number]
    given = {r.doc_id: r for r in crowded.collect()}
    out = stage(spark, crowded, bench_dir)
    if name == "sharding":
        assert out.columns == [*(f"{c}_source" if c in ("shard", "slot") else c for c in crowded.columns), "shard", "slot"]
        out = out.drop("shard", "slot")
    else:
        assert out.columns == crowded.columns
    rows = out.collect()
    assert rows and all(tuple(r) == tuple(given[r.doc_id]) for r in rows)


def test_operators_keep_or_replace_clashing_columns(spark, crowded):
    given = {r.doc_id: r for r in crowded.collect()}
    clean = pii.redacted(crowded)
    assert clean.columns == crowded.columns and all(tuple(r) == tuple(given[r.doc_id]) for r in clean.collect())
    assert pii.find(crowded).columns == [*(c for c in crowded.columns if c not in ("base", "spans")), "base", "spans"]
    judged = language.identify(crowded, crowded)
    assert judged.columns == [*(c for c in crowded.columns if c not in language.MADE), *language.MADE] and judged.where("score between 0 and 1").count() == len(given)
    taken = mixing.sampled(crowded, [3, 1, 2], 1.5)
    assert taken.columns == [*(c for c in crowded.columns if c not in mixing.MADE), *mixing.MADE] and taken.where("level like 'level:%'").count() == len(given)
    assert near_dup.near_duplicates(crowded).count() == token_count(spark, crowded) == len(given)


def token_count(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return token_records.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"), 2).count()


# Language


def plain_grams(text):
    out = Counter()
    low = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in b" " + (text or "").encode() + b" ")
    for i in range(len(low) - 2):
        gram = low[i : i + 3]
        if gram != b"   ":
            out[(int.from_bytes(gram, "little") * 0x9E3779B1 % 2**32) >> 16] += 1
    return out


def plain_shares(names, p, grams):
    """Expectation-maximisation in plain Python: shares and log-likelihood."""
    share = {x: 1 / len(names) for x in names}
    total = sum(grams.values())
    for _ in range(language.STEPS):
        new = dict.fromkeys(names, 0.0)
        for g, c in grams.items():
            whole = sum(share[x] * p[x][g] for x in names)
            for x in names:
                new[x] += c * share[x] * p[x][g] / whole
        share = {x: v / total for x, v in new.items()}
    return share, sum(c * math.log(sum(share[x] * p[x][g] for x in names)) for g, c in grams.items())


def plain_languages(known, texts):
    counts = defaultdict(Counter)
    for t, lang in known:
        if t is not None and lang is not None:
            counts[lang].update(plain_grams(t))
    names = sorted(counts)
    p = {}
    for x in names:
        n = sum(counts[x].values()) + language.SMOOTHING * language.BUCKETS
        p[x] = defaultdict(lambda n=n: language.SMOOTHING / n, {g: (c + language.SMOOTHING) / n for g, c in counts[x].items()})
    out = []
    for t in texts:
        grams = plain_grams(t)
        if not grams:
            out.append(({}, False))
            continue
        total = sum(grams.values())
        cost = language.PENALTY * math.log(max(2, total)) / 2
        full, bound = plain_shares(names, p, grams)
        rank = sorted(names, key=lambda x: (-full[x], x))
        best, value = {rank[0]: 1.0}, sum(c * math.log(p[rank[0]][g]) for g, c in grams.items())
        for k in range(2, len(names) + 1):
            if bound - (k - 1) * cost <= value:
                break
            share, like = plain_shares(rank[:k], p, grams)
            if like - (k - 1) * cost > value:
                best, value = share, like - (k - 1) * cost
        out.append((best, value > -total * math.log(language.BUCKETS)))
    return out


def test_language_against_plain_em(spark, corpus):
    rows = corpus.collect()
    extra = [(200 + i, f"{rows[i].text} {rows[i + 1].text}") for i in range(20)] + [(250, " ".join(r.text for r in rows[:60]) * 3)]
    docs = corpus.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = dict(zip([r.doc_id for r in docs.collect()], plain_languages([(r.text, r.lang) for r in rows], [r.text for r in docs.collect()]), strict=True))
    assert sum(len(s) > 1 for s, _ in want.values()) >= 10
    for r in language.identify(docs, corpus, F.col("doc_id")).collect():
        share, good = want[r.doc_id]
        assert {x.lang: x.share for x in r.languages} == pytest.approx(share, abs=1e-9) and r.accepted == (good and bool(share))
        assert r.lang_pred == (max(share, key=share.get) if share else "und") and r.score == pytest.approx(max(share.values(), default=0.0))


# Sharding


def plain_feistel(n, seed, x):
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    word = lambda j, what: int.from_bytes(hashlib.sha256(f"{seed}:{j}:{what}".encode()).digest()[:4], "little") % (sharding.PRIME - 1) + 1
    while True:
        left, right = x % a, x // a
        for j in range(sharding.ROUNDS):
            v = (right % sharding.PRIME * word(j, "a") + word(j, "b")) % sharding.PRIME
            left, right = right, (left + (v * v + word(j, "c")) % sharding.PRIME * (v | 1) % sharding.PRIME) % (b if j % 2 else a)
        x = right * a + left
        if x < n:
            return x


def test_sharding_against_plain_numbering(spark, corpus):
    docs = corpus.union(corpus.where("doc_id = 7")).union(corpus.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))
    plain = sorted(((r.doc_id is not None, r.doc_id or 0, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1, r.doc_id) for r in docs.collect()))
    want = []
    for i, (_, _, crc, size, doc_id) in enumerate(plain):
        place = plain_feistel(len(plain), 5, i)
        want.append((doc_id, size, crc, place % 8, place // 8))
    got = sharding.sharded(docs, 8, 5, keep=["doc_id"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, sharding.sharded(docs.repartition(7), 8, 5, keep=["doc_id"]).collect()), key=repr) == sorted(want, key=repr)


# Personal data


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_base(text):
    spans = []
    for place, (pattern, holds) in enumerate([
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(re.sub(r"\D", "", v)) <= 19 and luhn(re.sub(r"\D", "", v))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(re.sub(r"\D", "", v)) <= 15),
    ]):
        spans += [(m.start(), place, m.end()) for m in re.finditer(pattern, text or "") if holds(m[0])]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_spans_against_plain_patterns(spark):
    rng = np.random.default_rng(2)
    odd = ["a@b.c", "x.y+z@h-1.co.uk", "@", "a@@b.c", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+49", "é", "😀", " ", ",", ".", "-", "0", "00001.2.3.4", "a@b", "12345678901234567890123"]
    texts = ["".join(rng.choice(odd, 12)) for _ in range(300)] + ["9" * 3000 + " a@b.c", "a" * 100_000 + "@b.cd", None, ""]
    got = {r.doc_id: r for r in pii.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        want = plain_base(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))


def test_trees_add_spans_of_unseen_forms(spark):
    for kind, (n, recall, precision, base) in pii.held_out_quality(spark).items():
        assert n > 100 and precision > 0.9 and recall > 0.3 and base < 0.05, kind
    texts = ['auth token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "write ANNA AT gmail DOT com", "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962", "see anna at home. She left"]
    got = [r.spans for r in pii.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["secret:14:54", "email:6:27", "", ""]


# Near duplicates, top k, token records, mixing


def test_an_id_with_several_texts_links_their_groups(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    frame = spark.createDataFrame([(5, a), (7, a), (7, b), (9, b), (9, None), (8, "x y"), (11, b + " c"), (None, a)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(frame, 3, 85).collect()), key=str)
    assert got == sorted([(5, 5, True), (7, 5, False), (7, 5, False), (9, 5, False), (9, 9, True), (8, 8, True), (11, 5, False), (None, None, True)], key=str)


def test_hot_keys_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(20)] + [(100 + i, " ".join([*base[:-1], f"z{i}"])) for i in range(20)] + [(500, "other words here"), (501, None)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {i: 0 if i < 500 else i for i, _ in rows}
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", 0)
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()} == got


def test_top_k_takes_any_finite_vector(spark):
    rows = [(0, [1e7, 2.0]), (1, [1e30, 1.0]), (50, [1.0, -2.0]), (100, []), (2, [0.5, 0.5]), (3, [-1e30, 0.0]), (4, None), (5, [float("inf")])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 3, 256.0)
    whole = {i: [int(math.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows if v is not None and all(map(math.isfinite, v))}
    want = []
    for q in (0, 50, 100):
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], v, strict=False)))), i) for i, v in whole.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:3])]
    assert rows_of(got) == sorted(want, key=repr)
    assert top_k.top_k(spark.createDataFrame(rows[:0], "vec_id long, embedding array<float>"), F.lit(True), 3, 256.0).count() == 0


@pytest.mark.parametrize("group_bytes", [192 << 20, 200_000])
def test_top_k_ships_vectors_few_times(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(top_k, "BLOCK", 64)
    monkeypatch.setattr(top_k, "GROUP_BYTES", group_bytes, raising=False)
    shipped, searched = spark.sparkContext.accumulator(0), top_k._searched

    def counted(k, batches):
        def seen():
            for batch in batches:
                shipped.add(batch.nbytes)
                yield batch

        yield from searched(k, seen())

    monkeypatch.setattr(top_k, "_searched", counted)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(2000, 20)), np.tile(rng.normal(size=20), (1000, 1))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.lit(True), 3, 256.0).collect()
    whole = np.floor(256 * x.astype(np.float64)).astype(np.int64)
    score = whole @ whole.T
    np.fill_diagonal(score, -(2**62))
    best = np.argsort(-score, axis=1, kind="stable")[:, :3]
    assert sorted(map(tuple, got)) == [(i, r + 1, int(j), int(score[i, j])) for i in range(3000) for r, j in enumerate(best[i])]
    assert shipped.value < 30 * 3000 * (20 * 4 + 16)


def test_top_k_scores_stop_at_64_bits(spark):
    rows = [(0, [8e6] * 8), (1, [8e6] * 8), (2, [-8e6] * 8), (3, [1.0] * 8)]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 3, 256.0)
    assert rows_of(got) == sorted([(0, 1, 1, 2**63 - 1), (0, 2, 3, 8 * 256 * 256 * 8_000_000), (0, 3, 2, -(2**63))], key=repr)


def test_special_strings_are_the_librarys(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a b<|endoftext|>c d", "<|endoftext |>", "x <|endoftext|> y z"]
    assert [np.frombuffer(b, "<u2").tolist() for b in token_records.PieceEncoder(path).encode(pa.array(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_cut_where_letters_digits_and_marks_meet(monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    same = lambda encoder, texts: [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(pa.array(texts, pa.string()))] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = token_records.PieceEncoder(path)
    words, marks = ["tree", "été", "Weg"], ["(", "--", ".", "!?", "|"]
    texts = [f"{a} {m}{w}{n} {w}{m}\n{a}{n}{m}{w}  {a}" for a in words for w in words for m in marks for n in range(20)]
    assert same(encoder, texts)
    assert len(encoder.pieces) + len(encoder.plain) <= 2 * len(words) + 2 * len(marks) + 20 + 10  # equal parts are encoded once, whatever they touch
    atoms = [*"abZ05.,-'\"\n\t\r\x1c\x85\xa0é×ª\u1680\u2003\u3000\u0301Ж語😀", " ", " ", " the", "'s", "'ll", "  ", "\n\n", "<|endoftext|>"]
    pick = random.Random(7)
    texts = [None, "", *("".join(pick.choices(atoms, k=pick.randint(1, 30))) for _ in range(3000))]
    for window in (16, 100, 4 << 20):
        monkeypatch.setattr(token_records, "WINDOW", window)
        assert same(token_records.PieceEncoder(path), texts)


def test_token_files_are_bounded_in_bytes(spark, monkeypatch):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_records, "FILE_BYTES", 40_000)
    monkeypatch.setattr(token_records, "BUNDLE_BYTES", 2_000)
    rows = [(i, f"word {i} " * (1 + i % 50)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    path = common.new_path(spark, "t")
    token_records.write_tokens(frame, path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    index = token_records.read_index(spark, path)
    ends = {r.file: (r.end, r.n) for r in index.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.count("*").alias("n")).collect()}
    assert len(ends) > 8 and max(e for e, _ in ends.values()) <= 40_000 and sum(n for _, n in ends.values()) == 3000
    some = index.where("doc_id % 500 = 3").select("file", "offset", F.xxhash64("start").alias("rank"))
    assert sorted(r.doc_id for r in token_records.read_records(spark, path, some).collect()) == list(range(3, 3000, 500))
    assert token_records.token_table(frame.limit(0), public_tokenizers.path("byte_bpe_50k.json"), 2).count() == 0


def plain_fill(caps, weights, total):
    """Deals total by weight, capped, in plain Python."""
    got, open_ = {}, set(caps)
    while open_:
        level = (total - sum(got.values())) / sum(weights[x] for x in open_)
        full = {x for x in open_ if caps[x] <= level * weights[x]}
        if not full:
            return got | {x: level * weights[x] for x in open_}
        first = min(full, key=lambda x: caps[x] / weights[x])
        got[first] = caps[first]
        open_.remove(first)
    return got


def plain_mix(rows, weights, share, most, seed=0):
    """Copies of each (doc_id, text, source), in the order of rows."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    words = {s: sum(n for n, r in zip(size, rows, strict=True) if r[2] == s) for s in sources}
    target = plain_fill({s: most * words[s] for s in sources}, {s: weights[i % len(weights)] for i, s in enumerate(sources)}, share * sum(words.values()))
    copies = [0] * len(rows)
    for s in sources:
        mine = [i for i, r in enumerate(rows) if r[2] == s and size[i]]
        classes = Counter()
        for i in mine:
            classes[size[i].bit_length()] += size[i]
        level = plain_fill({b: most * n for b, n in classes.items()}, {b: n * (b + mixing.LENGTH_WEIGHT) for b, n in classes.items()}, target[s])
        ranked, wanted = [], target[s]
        for i in mine:
            expected = level[size[i].bit_length()] / classes[size[i].bit_length()]
            copies[i] = int(expected)
            wanted -= copies[i] * size[i]
            p = expected - int(expected)
            if p > 0:
                tie = hashlib.md5(f"{seed}:{'' if rows[i][0] is None else rows[i][0]}:{hashlib.md5(rows[i][1].encode()).hexdigest()}".encode()).hexdigest()
                u = (int(tie[:13], 16) + 0.5) / 2**52
                odds = (u / (1 - u)) / (p / (1 - p))
                ranked.append((int(odds / (1 + odds) * 2**52), rows[i][0] is None, rows[i][0] or 0, tie, i))
        ahead = 0
        for *_, i in sorted(ranked):
            copies[i] += ahead + size[i] / 2 <= wanted
            ahead += size[i]
    return copies


@pytest.mark.parametrize("partitions", [1, 7])
def test_mixing_against_plain_pareto(spark, corpus, partitions):
    rows = [(r.doc_id, r.text, r.source) for r in corpus.collect()] + [(300, "same words " * 9, "s1")] * 40 + [(None, f"no id {i}", "s2") for i in range(30)] + [(301, f"one id {i} " * (1 + i), "s3") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    want = Counter()
    for r, n in zip(rows, plain_mix(rows, [3, 1, 2], 1.2, 2), strict=True):
        want[(r, n)] += 1
    got = Counter(((r.doc_id, r.text, r.source), r.copies) for r in mixing.sampled(frame, [3, 1, 2], 1.2, 2).collect())
    assert got == want
    times = Counter(tuple(r) for r in mixing.mixed_rows(frame, [3, 1, 2], 1.2, 2).collect())
    total = Counter()
    for (r, n), c in want.items():
        total[r] += n * c
    assert times == Counter({r: n for r, n in total.items() if n})


# Chat, decontamination


def test_digests_of_a_table_read_again(spark, tmp_path):
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", f"{c} {i} " * 20_000) for c in range(3) for i in range(60)]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = rows_of(chat.digests(made))
    made.repartition(5, F.rand(1)).write.parquet(str(tmp_path / "formatted"))
    again = spark.read.parquet(str(tmp_path / "formatted"))
    assert made.where("part > 0").count() and rows_of(chat.digests(again, ordered=False)) == want
    with pytest.raises(Exception, match="ordered=False"):
        chat.digests(again).collect()
    assert chat.digests(chat.format_conversations(made.sparkSession.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def plain_contamination(docs, items, window):
    out = {}
    for i, text in docs:
        w = decontaminate.words_of(text)
        hit, found, best = set(), set(), (0, -1, -1, -1)
        for item, t in items:
            b = decontaminate.words_of(t)
            k = min(window, len(b))
            for p in range(len(w)):
                for q in range(len(b)):
                    n = 0
                    while p + n < len(w) and q + n < len(b) and w[p + n] == b[q + n]:
                        n += 1
                    if k and n >= k and (k == window or q == 0):
                        hit |= set(range(p, p + n))
                        found.add(item)
                        best = max(best, (n, -p, -item, -q)) if best[0] else (n, -p, -item, -q)
        out[i] = (len(w), len(hit), sorted(found), *((best[0], -best[1], -best[2], -best[3]) if found else (0, None, None, None)))
    return out


@pytest.mark.parametrize("part, shard", [(8 << 20, 16 << 20), (1, 1)])
def test_contamination_against_plain_search(spark, monkeypatch, part, shard):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    rng = np.random.default_rng(4)
    items = [(i, " ".join(rng.choice(list("abcd"), n))) for i, n in enumerate([9, 12, 4, 1, 30, 0, 12])] + [(4, "q r s t u v")]
    docs = [(i, " ".join(rng.choice(list("abcdx"), int(rng.integers(0, 60))))) for i in range(40)] + [(50, f"x {items[4][1]} y {items[1][1]}"), (51, None), (52, items[1][1] + items[4][1]), (53, "q r s t u")]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), 5)
    rows = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.longest_words, r.longest_at, r.longest_item, r.longest_item_at) for r in got.collect()}
    assert rows == plain_contamination(docs, items, 5)


def test_long_texts_cross_slices(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    long = "filler words " * 60_000 + passage + " more filler" * 60_000
    frame = spark.createDataFrame([(1, long), (2, passage), (3, long + " end")], "doc_id long, text string")
    hits = decontaminate.contamination(frame, spark.createDataFrame([(9, passage)], "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_hit, r.longest_words) for r in hits} == {i: (15, 15) for i in (1, 2, 3)}
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(frame, 3, 85).collect()} == {1: 1, 2: 2, 3: 1}


# The pipeline, stage by stage


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def test_pipeline_against_plain_stages(spark, corpus, bench_dir):
    rows = [tuple(r) for r in corpus.collect()]
    judged = plain_languages([(r[1], r[2]) for r in rows], [r[1] for r in rows])
    kept = [r for r, (share, good) in zip(rows, judged, strict=True) if share and good]
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language"](spark, corpus, bench_dir)
    assert rows_of(docs) == sorted(kept, key=repr)

    sets = {r[0]: shingles(r[1], 5) for r in kept}
    comp = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    kept = [r for r in kept if comp[r[0]] == r[0]]
    docs = stages["near_duplicates"](spark, docs, bench_dir)
    assert rows_of(docs) == sorted(kept, key=repr) and len(kept) < len(sets)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{bench_dir}/benchmark.parquet").collect()]
    hit = {i for i, v in plain_contamination([r[:2] for r in kept], items, 10).items() if v[1]}
    kept = [r for r in kept if r[0] not in hit]
    docs = stages["decontamination"](spark, docs, bench_dir)
    assert hit and rows_of(docs) == sorted(kept, key=repr)

    copies = plain_mix([(r[0], r[1], r[3]) for r in kept], [3, 1, 2], 1.5, 2)
    kept = [r for r, n in zip(kept, copies, strict=True) for _ in range(n)]
    docs = stages["mixing"](spark, docs, bench_dir)
    assert rows_of(docs) == sorted(kept, key=repr)

    order = sorted(kept, key=lambda r: (r[0], zlib.crc32(r[1].encode()), len(r[1].encode())))
    places = [plain_feistel(len(order), 5, i) for i in range(len(order))]
    want = sorted(((*r, p % 8, p // 8) for r, p in zip(order, places, strict=True)), key=repr)
    assert rows_of(stages["sharding"](spark, docs, bench_dir)) == want


def test_empty_corpus_through_all_stages(spark, corpus, bench_dir):
    docs = corpus.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, bench_dir)
    assert docs.count() == 0
