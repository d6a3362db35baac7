"""Small cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafmark.llm import chat, decontaminate, language, mixing, near_dup, pii, ppm, sharding, token_records, top_k

DOC = "doc_id long, text string, lang string, source string, n_chars long, comp string, size string, block string"
A = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", "  \n", "word", "two words", A, A, A + " extra", A.upper(), "x " * 20_000, "Ünïcode ß straße", "12 34 $$"]
    rows = [(i, t, None if i == 5 else "en", None if i % 4 == 3 else f"s{i % 3}", 0, "c", "s", "b") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id", "de", "s1", 1, "c", "s", "b")], DOC)


def shingled(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def test_near_duplicates_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    known = {r.doc_id: shingled(r.text, 3) for r in docs.collect() if r.doc_id is not None}
    comp = {i: i for i in known}
    for _ in known:
        for i in known:
            for j in known:
                if known[i] and known[j] and 100 * len(known[i] & known[j]) >= 85 * len(known[i] | known[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    assert {i: (len(s), comp[i]) for i, s in known.items()} == {i: (got[i].n_shingles, got[i].component_id) for i in known}
    assert got[None].kept and got[None].component_id is None
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_group_of_near_copies_without_a_centre(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # a chain: neighbours are similar, the ends are not
        words = base.copy()
        for j in range(i):
            words[2 * j] = f"x{j}"
        rows.append((i, " ".join(words)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85).collect()
    assert {r.component_id for r in got} == {0}


def test_contamination_cases(spark, docs):
    bench = spark.createDataFrame([(1, A), (2, "two WORDS"), (3, None), (4, "!!"), (None, "word"), (5, A)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert (got[5].n_words, got[5].n_hit, got[5].item_ids) == (16, 16, [1, 5]) and got[8].contaminated
    assert (got[4].n_hit, got[4].item_ids) == (2, [2]) and not got[3].contaminated and not got[0].n_words
    assert (got[7].longest_words, got[7].longest_at, got[7].longest_item, got[7].longest_item_at) == (16, 0, 1, 0)
    assert decontaminate.clean_documents(docs, bench).where("doc_id in (4, 5, 6, 7, 8)").count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_ppm_against_a_plain_one(spark, docs, monkeypatch):
    monkeypatch.setattr(ppm, "ENTRIES", 1 << 50)
    small = docs.where("doc_id <> 9 and doc_id is not null")
    got = {r.doc_id: r for r in ppm.score_texts(small, F.col("doc_id") % 2 == 1, F.col("doc_id") % 2 == 0).collect()}
    table, words = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)], Counter()
    symbols = lambda t: (256,) * ppm.ORDER + tuple((t or "").encode()) + (256,)
    tokens = lambda t: [*"".join(c.lower() if c.isascii() else c for c in t or "").encode().split(), b" "]
    rows = {r.doc_id: r.text for r in small.distinct().collect()}
    for r in small.collect():
        if r.doc_id % 2:
            words.update(tokens(r.text))
            s = symbols(r.text)
            for p in range(ppm.ORDER, len(s)):
                for k in range(ppm.ORDER + 1):
                    table[k][s[p - k : p]][s[p]] += 1
    n, v = sum(words.values()), len(words)
    for i, text in rows.items():
        s, total = symbols(text), 0.0
        for p in range(ppm.ORDER, len(s)):
            out = set()
            for k in range(ppm.ORDER, -1, -1):
                left = {a: c for a, c in table[k].get(s[p - k : p], {}).items() if a not in out}
                if left:
                    d, m = len(left), sum(left.values())
                    if s[p] in left:
                        total += math.log10(left[s[p]] / (m + d))
                        break
                    total += math.log10(d / (m + d))
                    out |= set(left)
            else:
                total -= math.log10(257 - len(out))
        assert got[i].score == pytest.approx(total) and got[i].train_tokens == n
        assert got[i].base_score == pytest.approx(sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens(text)))
    assert ppm.score_texts(docs.limit(0), F.lit(True), F.lit(False)).count() == 0


def plain_ppm(training, texts):
    table = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    symbols = lambda t: (256,) * ppm.ORDER + tuple((t or "").encode()) + (256,)
    runs = Counter()
    for t in training:
        s = symbols(t)
        runs.update(s[p - ppm.ORDER : p + 1] for p in range(ppm.ORDER, len(s)))
    for run, n in runs.items():
        for k in range(ppm.ORDER + 1):
            table[k][run[ppm.ORDER - k : ppm.ORDER]][run[ppm.ORDER]] += n
    scores = []
    for t in texts:
        s, total = symbols(t), 0.0
        for p in range(ppm.ORDER, len(s)):
            out = set()
            for k in range(ppm.ORDER, -1, -1):
                left = {a: c for a, c in table[k].get(s[p - k : p], {}).items() if a not in out}
                if left:
                    d, m = len(left), sum(left.values())
                    if s[p] in left:
                        total += math.log10(left[s[p]] / (m + d))
                        break
                    total += math.log10(d / (m + d))
                    out |= set(left)
            else:
                total -= math.log10(257 - len(out))
        scores.append(total)
    return scores


def test_ppm_keeps_rare_entries_of_a_large_corpus(spark):
    rare = ["Quokkas juggle vexing zithers.", "Zwölf Boxkämpfer jagen Viktor", None, "", "quick zithers, zwölf quokkas"]
    rows = [(2 * i + 1, "ab" * 100_000 + f" {i}") for i in range(12)] + [(100 + i, t) for i, t in enumerate(rare)] + [(101, rare[1])]
    training = [t for i, t in rows if i % 2 or i == 100]
    assert sum(len(t or "") for t in training) > 2 * ppm.ENTRIES
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in ppm.score_texts(frame, (F.col("doc_id") % 2 == 1) | (F.col("doc_id") == 100), F.lit(False)).where("doc_id >= 100").collect()}
    assert [got[100 + i] for i in range(len(rare))] == pytest.approx(plain_ppm(training, rare))


@pytest.mark.parametrize("entries, at_once", [(0, 1), (1, 10), (40, 100)])
def test_ppm_joins_what_is_not_broadcast(spark, docs, monkeypatch, entries, at_once):
    monkeypatch.setattr(ppm, "ENTRIES", entries)
    monkeypatch.setattr(ppm, "SCORED", at_once)
    rows = [r for r in docs.collect() if r.doc_id not in (9, None)]
    frame = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: r.score for r in ppm.score_texts(frame, F.col("doc_id") % 2 == 1, F.lit(False)).collect()}
    want = plain_ppm([r.text for r in rows if r.doc_id % 2], [r.text for r in rows])
    assert [got[r.doc_id] for r in rows] == pytest.approx(want)


def test_language_cases(spark, docs):
    got = {r.doc_id: r for r in language.identify(docs, docs, F.col("doc_id"), F.col("source")).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 11)] == ["und"] * 4 and got[0].score == 0 and not got[11].accepted
    assert got[5].lang_pred in ("en", "de") and 0 < got[5].score <= 1
    assert {r.lang_pred for r in language.identify(docs, docs.limit(0), F.col("doc_id")).collect()} == {"und"}


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 90), f"s{i % 3}" if i % 10 else None) for i in range(2000)]
    mix = mixing.sampled(spark.createDataFrame(rows, "doc_id long, text string, source string"), [3, 1, 2], 1.5)
    for r in mix.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most")).collect():
        assert abs(r.taken - r.target) <= 100 and r.most <= 2
    assert mixing.sampled(mix.limit(0).select("doc_id", "text", "source"), [3, 1, 2], 1.5).count() == 0


def test_sharding_is_a_permutation(spark, docs):
    rows = sharding.sharded(docs, 3, 1).collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted((p % 3, p // 3) for p in range(len(rows)))
    assert sharding.sharded(docs.limit(0), 3, 1).count() == 0
    for n in (1, 2, 7, 1000):
        f = sharding.Feistel(n, 3)
        x = np.arange(n)
        assert sorted(f.permute(x)) == list(range(n)) and (f.inverse(f.permute(x)) == x).all()


def test_token_records_round_trip(spark, docs):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    odd = ["a  b", " a", "a ", "\n b  c\n\n d", "x\t y", "<|endoftext|> z", "it 's we'll don't", "a  b", "a\x1c b", "end.\nNext, (one) x.\n\ny", "a.\nb", "1.\nA2"]
    assert [np.frombuffer(b, "<u2").tolist() for b in token_records.PieceEncoder(path).encode(pa.array(odd))] == [plain.encode(t, add_special_tokens=False).ids for t in odd]
    rows = sorted(token_records.token_table(docs, path, 2).collect(), key=lambda r: r.start)
    start = 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        ids = [*plain.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    data = bytearray(token_records.frame(b"payload"))
    data[14] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(memoryview(data), 0)


def test_chat_round_trip(spark):
    hard = ["<|im_end|>\n<|im_start|>assistant\nx", "<\\|", "<\\\\|a<|", "", None, "é😀"]
    rows = [(1, i, "assistant" if i % 2 else "us\\er\n<|", t) for i, t in enumerate(hard)] + [(None, 0, None, "no id"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: chat.parse(r.formatted) for r in made.collect()}
    assert got[1] == [(r[2], r[3] or "") for r in rows[:6]] and got[None] == [("", "no id")] and len(got[2]) == 2
    digest = {r.conv_id: r for r in chat.digests(made).collect()}
    said = "".join(t or "" for t in hard[1::2])
    assert digest[1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and digest[1].loss_chars == len(said)


def test_long_conversation_in_parts(spark, monkeypatch):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", "t" * 1000) for i in range(6000)]
    d = chat.digests(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in d] == [(7, 6000, 3_000_000)]


def test_top_k_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=24)]) for i in range(300)] + [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, []), (None, [1.0]), (50, [0.5] * 30), (299, [0.5] * 30)]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 5, 256.0)
    good = [(i, np.pad(np.floor(256 * np.array(v, np.float32).astype(float)), (0, 30 - len(v))).astype(int)) for i, v in rows if i is not None and v and None not in v and not np.isnan(v).any()]
    want = []
    for a, (i, v) in enumerate(good):
        if i % 50 == 0:
            want += [(i, r + 1, j, s) for r, (s, j) in enumerate(sorted(((int(v @ w), j) for b, (j, w) in enumerate(good) if b != a), key=lambda t: (-t[0], t[1]))[:5])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pii_cases(spark, docs):
    text = "a@b.c_d@e.f 4111 1111 1111 1111, 1.2.3.4.5.6.7.8 300.1.1.1 +1 (555) 123-4567 é😀 mail me: bob [at] home.com"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "1" * 5000 + "a" * 5000 + "@")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.counts(rows).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (2, 2, 1, 1)
    assert "bob" not in pii.redacted(rows.where("doc_id = 1")).first().text and got[2].spans == got[4].spans == ""
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest() and pii.redacted(docs).columns == docs.columns


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline

    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "two words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        ids = {r.doc_id for r in kept.collect()}
        assert not ids & {0, 1, 2, 11} and 10 in ids
        if name != "language":
            assert 5 in ids and not ids & {6, 8}
    assert 4 not in ids
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.select("shard", "slot").distinct().count() == out.count()


def test_pipeline_judges_each_row_by_its_own_text(spark):
    import corpus_pipeline

    other = " ".join(f"b{i}" for i in range(30))
    rows = [(1, A), (2, A), (2, other), (3, "x y z one two"), (3, "q r s three four"), (None, A), (None, "some words without an id here"), (None, "some words without an id here"), (4, other), (5, "x y z one two"), (5, "x y z one two")]
    frame = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame, "")
    assert kept.columns == frame.columns
    want = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if not any(10 * len(shingled(t, 5) & shingled(u, 5)) >= 8 * len(shingled(t, 5) | shingled(u, 5)) for u in want):
            want[t] = i
    assert sorted(((r.text, r.doc_id) for r in kept.collect()), key=str) == sorted(want.items(), key=str)


def test_language_mixture_of_all_four(spark):
    rng = np.random.default_rng(3)
    texts = {lang: [" ".join("".join(rng.choice(list(letters), 5)) for _ in range(60)) for _ in range(10)] for lang, letters in {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst"}.items()}
    rows = [(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mixed = spark.createDataFrame([(1, " ".join(ts[0] for ts in texts.values()), None), (2, texts["aa"][0], None)], known.schema)
    got = {r.doc_id: {s.lang: s.share for s in r.languages} for r in language.identify(mixed, known, F.col("doc_id")).collect()}
    assert sorted(got[1]) == sorted(texts) and max(got[1].values()) < 0.3 and sorted(got[2]) == ["aa"]
