"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import math
import pickle
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from sluice.llm import bpe, decontam, eliasfano, langid, ngramlm, quality, queries, recount, rules, sharding, simhash, simhash_similar, urls
from sluice.llm.common import keep_where, sample
from tests import oracle

VOCABULARY = public_tokenizers.path(queries.VOCABULARY)
ODD = ["", None, " \n\t ", "a", "The The", "x" * 60_000, "un été 漢字 🎉 １２", "a b " * 9_000, "it's 'll 3.14  \r\n  end "]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, a repeated row, a row without an id, and columns that operators use inside."""
    data = [*enumerate(ODD), (3, "a"), (3, "a"), (None, "no id"), (None, None)]
    columns = "doc_id long, text string, score double, piece int, lang string, fp long, shard string, label int, words string"
    return spark.createDataFrame([(i, t, 0.5, 1, "en", 7, "s", 1, "w") for i, t in data], columns)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def own():
    return bpe.tokenizer(VOCABULARY)


def test_queries_agree_with_sql(spark, sf_dir):
    con = oracle.connect(sf_dir)
    for name, sql in queries.oracle_sql().items():
        oracle.compare(queries.queries()[name](spark, sf_dir), con, sql)


def test_many_edits_of_a_long_text(own):
    """100,000 equal lines are dropped in seconds; what is left, and trees of random edits that empty whole leaves, count
    as when they are encoded whole."""
    text = "head\n" + "the same line, again 12\n" * 100_000 + "tail 7\n"
    begin, tree = time.monotonic(), recount.Tree.of(text, own)
    for e in recount.repeated_lines(text):
        tree.edit(*e)
    left = "head\nthe same line, again 12\ntail 7\n"
    assert time.monotonic() - begin < 60 and tree.text() == left and len(tree) == len(recount.Tree.of(left, own)) and tree.chars[1] == len(left)
    again = recount.Tree(own, *tree.row())
    again.edit(0, 5, "")
    assert again.text() == left[5:]
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "word", "it's", "12", "\n\n", "é漢"]) for _ in range(4000))
    tree = recount.Tree.of(text, own)
    for _ in range(300):
        start = rng.randrange(len(text) + 1)
        end, new = min(len(text), start + rng.choice([0, 3, 400])), rng.choice(["", "", " x", "y 1 " * 40])
        text = text[:start] + new + text[end:]
        tree.edit(start, end, new)
        if rng.random() < 0.1:
            tree = recount.Tree(own, *tree.row())
    assert tree.text() == text and len(tree) == len(recount.Tree.of(text, own))


def test_digests_are_those_of_tiktoken(spark, odd, own):
    """Both digests of whole texts against the library's ids and their bytes."""
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})
    want = []
    for r in odd.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(odd, VOCABULARY).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ids_that_are_not_in_the_vocabulary(spark, own):
    df = spark.createDataFrame([(1, [-1, None, 0, len(own.table)]), (2, None), (None, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.bytes) for r in bpe.decode(df, VOCABULARY).collect()}
    bad = "\ufffd".encode()
    assert got == {1: bad + bad + own.table[0] + bad, 2: b"", None: b""}


def test_shards_are_written_in_bounded_files(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"), F.lit(1).alias("_row"), F.lit(2).alias("_file"))
    sharding.write(df, str(tmp_path / "out"), 3, file_rows=40)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 500 and set(got.columns) == {"doc_id", "text", "_row", "_file", "slot", "shard"}
    for shard in range(3):
        assert sorted(r.slot for r in got.where(F.col("shard") == shard).collect()) == list(range(got.where(F.col("shard") == shard).count()))
    assert len(list(tmp_path.glob("out/shard=0/*.parquet"))) > 1


# ---- samples -------------------------------------------------------------------------------------------------------


def test_samples_of_repeated_texts_and_long_ones(spark):
    """400,000 copies of a few texts leave all of them, and a class of long texts is learnt from in pieces."""
    few = spark.range(400_000).select(F.lit("few").alias("c"), F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("t"))
    long = spark.range(30).select(F.lit("long").alias("c"), F.repeat(F.concat(F.lit("wörter "), F.col("id").cast("string"), F.lit(" ")), 30_000).alias("t"))
    rest = spark.range(50_000).select(F.lit("many").alias("c"), F.col("id").cast("string").alias("t"))
    got = sample(few.unionByName(long).unionByName(rest).unionByName(spark.createDataFrame([(None, "x"), ("few", None), ("few", "")], "c string, t string")), "c", "t", 3_000, 3 << 20)
    found = {r.c: (r.n, r.size) for r in got.groupBy("c").agg(F.count("*").alias("n"), F.sum(F.octet_length("t")).alias("size")).collect()}
    assert found["few"][0] == 4 and 700 <= found["many"][0] <= 1000
    assert 0.5 * (1 << 20) <= found["long"][1] <= 1 << 20 and got.where("c = 'long'").agg(F.max(F.octet_length("t"))).first()[0] <= (1 << 20) // 64


def test_a_language_of_long_texts_is_known(spark):
    rows = [(f"uno dos tres {i} ", "es") for i in range(300)] + [("eins zwei drei vier " * 40_000, "de")] * 3
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), size=1 << 20)
    got = langid.predict(spark.createDataFrame([(1, "drei vier"), (2, "dos tres")], "doc_id long, text string"), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {1: "de", 2: "es"}


# ---- 1 -------------------------------------------------------------------------------------------------------------


def test_quality_is_learnt(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op1_quality_gam(spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_tables_add_up():
    rng = np.random.default_rng(0)
    x = np.zeros((600, len(quality.FEATURES)))
    x[:, 0], x[:, 1] = rng.random(600), rng.random(600)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # nothing alone, all together
    model = quality.train(x, y)
    assert np.mean((quality.evaluate(model, x) > 0.5) == y) > 0.9
    one = x[:1]
    total = model["start"] + sum(t[np.searchsorted(e, one[0, f], side="right")] for f, (e, t) in enumerate(zip(model["edges"], model["tables"], strict=True)))
    total += sum(t[np.searchsorted(model["edges"][i][3::4], one[0, i], side="right"), np.searchsorted(model["edges"][j][3::4], one[0, j], side="right")] for i, j, t in model["pairs"])
    assert math.isclose(quality.evaluate(model, one)[0], 1 / (1 + math.exp(-total)))
    assert quality.evaluate(quality.train(x, np.ones(600)), x).min() > 0.9
    assert quality.evaluate(quality.train(x[:0], y[:0]), x)[0] == 0.5


def test_quality_odd(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None), (3, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    assert quality.score(odd, model).count() == odd.count() and quality.score(empty, model).count() == 0
    assert quality.score(odd, quality.fit(empty, labels.limit(0))).where("score = 0.5").count() == odd.count()


# ---- 2 -------------------------------------------------------------------------------------------------------------


def test_bpe_is_what_tiktoken_gives(own, texts):
    assert bpe.PATTERN == public_tokenizers.PATTERN
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(1)
    alphabet = "ab 'sre\n\t  ñ漢字한🎉\u0000▁Ġ<unk>1２٣.,　꟎᛿\U00011de1!"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    for text in [t or "" for _, t in texts] + made + [t or "" for t in ODD]:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids).decode() == text


def test_bpe_rows(spark, odd, empty, own):
    rows = bpe.digests(odd, VOCABULARY).collect()
    assert len(rows) == odd.count() and bpe.digests(empty, VOCABULARY).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (0, 1)} == {(0, nothing, nothing)}
    ids = bpe.encode(odd, VOCABULARY)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(ids, VOCABULARY).where("doc_id is not null").collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(ODD)}


# ---- 3 -------------------------------------------------------------------------------------------------------------


def test_languages_of_unseen_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_backs_off(spark, odd, empty):
    train = spark.createDataFrame([("the cat sat on the mat", "en"), ("le chat et la souris", "fr"), (None, "fr"), ("junk", None)], "text string, lang string")
    scorer = langid.Scorer(langid.fit(train))
    assert scorer.score("the") [0] == "en" and scorer.score("souriss")[0] == "fr" and scorer.score("matz")[0] == "en"
    assert scorer.score("12 !?") == ("und", 0.0) == scorer.score(None) and scorer.word("Ω") is None
    total, least = scorer.word("cat"), math.log10(0.5 / 6)  # the larger language has six words
    assert math.isclose(total[0], math.log10(1 / 6)) and math.isclose(total[1], least)
    model = langid.fit(train)
    assert langid.predict(odd, model).count() == odd.count() and langid.predict(empty, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(train.limit(0))).collect()} == {"und"}
    small = langid.Scorer(model, limit=2)  # its rows are forgotten between texts
    assert [small.score(t) for t in ("the cat sat", "le chat", "on the mat the")] == [scorer.score(t) for t in ("the cat sat", "le chat", "on the mat the")]


def test_language_scores_by_plain_dictionaries(spark):
    rng = random.Random(6)
    rows = [(" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))) for _ in range(30)), lang) for lang, letters in (("x", "abcde"), ("y", "cdefg"), ("z", "aceg")) for _ in range(20)]
    scorer = langid.Scorer(langid.fit(spark.createDataFrame(rows, "text string, lang string")))
    counts = {k: {lang: Counter() for lang in "xyz"} for k in range(6)}
    for text, lang in rows:
        for w in text.split():
            counts[0][lang][w] += 1
            for k in range(1, 6):
                m = f"<{w}>" if k > 1 else w
                counts[k][lang].update(m[i : i + k] for i in range(len(m) - k + 1))
    totals = {k: {lang: sum(c.values()) for lang, c in by.items()} for k, by in counts.items()}
    log = lambda k, lang, g: math.log10((counts[k][lang][g] or 0.5 * totals[k][lang] / max(totals[k].values())) / totals[k][lang])
    for word in [w for t, _ in rows for w in t.split()][:200] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(200)]:
        for k in range(6) if any(counts[0][lang][word] for lang in "xyz") else (5, 4, 3, 2, 1):
            m = f"<{word}>" if k > 1 else word
            grams = [word] if k == 0 else [m[i : i + k] for i in range(len(m) - k + 1)]
            if any(counts[k][lang][g] for g in grams for lang in "xyz"):
                assert np.allclose(scorer.word(word), [sum(log(k, lang, g) for g in grams) / len(grams) for lang in "xyz"])
                break
        else:
            assert scorer.word(word) is None


def test_language_keeps_what_occurs_once(spark):
    """Whatever the size of the rest: a single occurrence in a text that is learnt from is a known word."""
    rows = spark.range(4000).selectExpr("concat('common words of a text ', id % 3) AS text", "'en' AS lang")
    rows = rows.unionByName(spark.createDataFrame([("common " * 30_000 + "zebra", "en"), ("le chat", "fr")], "text string, lang string"))
    scorer = langid.Scorer(langid.fit(rows))
    assert "zebra" in scorer.known[0] and scorer.score("zebra")[0] == "en"


def test_samples_are_bounded(spark):
    rows = spark.range(9000).selectExpr("if(id % 10 = 0, 'small', 'large') AS c", "concat('text ', if(id % 3 = 0, 0, id)) AS t", "1 AS n", "2 AS h")
    got = sample(rows, "c", "t", 400, 1 << 20).collect()
    by = Counter(r.c for r in got)
    assert all(170 <= n <= 200 for n in by.values()) and len(by) == 2 and len({(r.c, r.t) for r in got}) == len(got)  # copies count as one
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, sample(rows.repartition(7), "c", "t", 400, 1 << 20).collect()))
    assert sum(len(r.t) for r in sample(rows, "c", "t", 10**6, 30_000).collect()) <= 30_000
    assert 0 < sample(rows.selectExpr("cast(n * hash(t) as string) AS c", "t"), "c", "t", 50, 1 << 30).count() <= 50
    assert sample(rows.selectExpr("cast(null as string) AS c", "t"), "c", "t", 9, 99).count() == 0


# ---- 4 -------------------------------------------------------------------------------------------------------------


def test_elias_fano(tmp_path):
    rng = np.random.default_rng(2)
    for i, values in enumerate([np.arange(5), np.sort(rng.integers(0, 1 << 40, 200_000)), np.unique(rng.integers(0, 10**6, 70_000)), np.array([7]), np.zeros(0, dtype=np.int64)]):
        sequence = eliasfano.Sequence.write(f"{tmp_path}/{i}", values)
        assert (np.concatenate([np.zeros(0, dtype=np.int64), *(sequence.block(k) for k in range(-(-len(values) // eliasfano.BLOCK)))]) == values).all()
        wanted = np.unique(rng.integers(0, int(values.max()) + 2 if len(values) else 9, 500))
        wanted = np.unique(np.r_[wanted, values[::97]])
        place, equal = sequence.successor(wanted)
        assert (place == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()
        if len(values):
            at = np.unique(rng.integers(0, len(values), 50))
            assert (sequence.at(at) == values[at]).all()
            size = sum(x.size * 8 for x in (sequence.low, sequence.high) if x is not None)
            assert size <= len(values) * (3 + sequence.bits) + 64 and sequence.bits <= max(0, math.log2(max(1, values[-1] / len(values))))
    assert sequence.n == 0


def scores(rows, mu=ngramlm.MU, nu=ngramlm.NU):
    """Score, base score, tokens and known tokens of each text, from plain dictionaries."""
    split = lambda t: [*(t or "").encode().lower().split(), None]
    one, two, three = Counter(), Counter(), Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2 if i is not None else True:
            a = b = 0
            for w in split(t):
                one[w] += 1
                two[b, w] += 1
                three[a, b, w] += 1
                a, b = b, w
    after1, after2 = Counter(), Counter()
    for (a, b, _), n in three.items():
        after1[b] += n
        after2[a, b] += n
    total = sum(one.values()) + len(one) + 1
    for _, t in rows:
        a = b = 0
        score = base = 0.0
        for w in split(t):
            top = three[a, b, w] + nu * two[b, w] + mu * (one[w] + 1) / total
            score += math.log10(top / (after2[a, b] + nu * after1[b] + mu))
            base += math.log10((one[w] + 1) / total)
            a, b = b, w
        yield score, base, len(split(t)), sum(one[w] > 0 for w in split(t))


TRAINS = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 <> 2"


@pytest.mark.parametrize("piece", [ngramlm.PIECE, 1500])  # in one piece, and in many with words that are spread
def test_ngram_scores(docs, texts, piece):
    got = {r.doc_id: r for r in ngramlm.score(docs, TRAINS, piece=piece).collect()}
    assert len(got) == len(texts)
    for (i, _), (score, base, n, known) in zip(texts, scores(texts), strict=True):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.held_out) == (n, known, zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and abs(r.score - score) < 1e-3 * n
    assert {r.train_tokens for r in got.values()} == {sum(n for (i, _), (*_, n, _) in zip(texts, scores(texts), strict=True) if zlib.crc32(str(i).encode()) % 7 != 2)}


def test_ngram_words_with_one_usual_predecessor(spark):
    """Each word of a passage is spread, and all its training bigrams lie in one piece; other texts have others."""
    passage = [f"w{i}" for i in range(20)]
    rows = [(i, " ".join(passage)) for i in range(300)]
    rows += [(i, " ".join(random.Random(i).sample(passage, 20))) for i in range(300, 400) if zlib.crc32(str(i).encode()) % 7 == 2]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ngramlm.score(df, TRAINS, piece=100).collect()}
    agree(got, rows)


def agree(got, rows):
    for (i, _), (score, base, n, known) in zip(rows, scores(rows), strict=True):
        assert (got[i].n_known, got[i].n_tokens) == (known, n)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and abs(got[i].score - score) < 1e-3 * n


def test_ngram_pairs_that_are_half_of_all_words(spark):
    """One pair is dealt to many pieces by the word before it, and has its count in each of them."""
    rng = random.Random(14)
    rows = [(i, " ".join(x for _ in range(12) for x in (f"v{rng.randrange(300)}", "of", "the"))) for i in range(250)]
    rows += [(i, " ".join(rng.choice(["of", "the", "of the", "the of", f"v{rng.randrange(400)}"]) for _ in range(20))) for i in range(250, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    own = ngramlm.statistics(df.withColumn("trains", F.lit(True)), 300)
    assert len(own.hot.pairs) > 0 and len(own.hot.words) <= ngramlm.HOT * own.pieces
    agree({r.doc_id: r for r in ngramlm.score(df, TRAINS, piece=300).collect()}, rows)
    shared = spark.sparkContext.broadcast((own.hot, own.frequent))
    grams = lambda t: sum(len(ngramlm._unpack(r.payload, own.frequent)[1][0]) for r in t if r.kind == 1)
    dealt = ngramlm._dealt(df.withColumn("trains", F.lit(True)), own.pieces, shared).collect()
    by = {k: grams([r for r in dealt if r.piece == k]) for k in {r.piece for r in dealt}}
    assert len(by) > own.pieces / 2 and max(by.values()) < 0.2 * sum(by.values())


def test_ngram_hot_passage_is_one_gram_a_lot(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same passage in all of them").alias("text"), F.lit(True).alias("trains")).repartition(2)
    own = ngramlm.statistics(df, 500)
    shared = spark.sparkContext.broadcast((own.hot, own.frequent))
    for r in ngramlm._dealt(df, own.pieces, shared).where("kind = 1").collect():
        assert len(ngramlm._unpack(r.payload, own.frequent)[1][0]) <= 8


def test_ngram_model_is_stored_and_asked_again(spark, tmp_path, docs, texts):
    for piece in (ngramlm.PIECE, 1500):
        at = f"{tmp_path}/{piece}"
        ngramlm.fit(docs.where(TRAINS), at, piece=piece)
        expected = {r.doc_id: r for r in ngramlm.score(docs, TRAINS, piece=piece).collect()}
        got = ngramlm.score_with(docs, at).collect()
        assert len(got) == len(expected)
        for r in got:
            e = expected[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (e.n_tokens, e.n_known, e.train_tokens)
            assert math.isclose(r.score, e.score, rel_tol=1e-5) and math.isclose(r.base_score, e.base_score, rel_tol=1e-9)
    strange = spark.createDataFrame([(1, "words that nobody has seen qqq"), (2, None)], "doc_id long, text string")
    assert {r.n_tokens for r in ngramlm.score_with(strange, at).collect()} == {7, 1} and ngramlm.score_with(strange.limit(0), at).count() == 0


def test_ngram_search_stays_between_pointers(tmp_path):
    rng = np.random.default_rng(15)
    grams = np.unique(rng.integers(0, 40, (3000, 3)), axis=0)
    counts = rng.integers(1, 9, len(grams))
    nothing = ngramlm.Hot(*(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.uint64, np.int64)))
    words = np.arange(100, 140, dtype=np.uint64)
    trie = ngramlm.Trie.write(str(tmp_path), words, grams.T, counts, nothing, 1e-3)
    one, two = np.unique(grams[:, 0]), np.unique(grams[:, :2], axis=0)
    parents, ranks = (x.ravel() for x in np.meshgrid(np.arange(len(one)), np.arange(40), indexing="ij"))
    found = trie.children(2, parents, ranks)
    expected = {(w, b): i for i, (w, b) in enumerate(two.tolist())}
    assert found.tolist() == [expected.get((int(one[p]), r), -1) for p, r in zip(parents, ranks.tolist(), strict=True)]
    assert trie.begin2.n == len(one) + 1 and trie.begin3.n == len(two) + 1 and trie.level3.n == len(grams)
    top, under, count = trie.look_up(*grams.T, 1e-3, nothing, words)
    c1, c2 = Counter(), Counter()
    for (w, b, _), n in zip(grams.tolist(), counts.tolist(), strict=True):
        c1[w] += n
        c2[w, b] += n
    assert count.tolist() == [c1[w] for w, *_ in grams.tolist()]
    assert np.allclose(top, [math.log10(n + ngramlm.NU * c2[w, b] + 1e-3 * (c1[w] + 1)) for (w, b, _), n in zip(grams.tolist(), counts.tolist(), strict=True)], atol=1e-3)
    assert np.allclose(under, [math.log10(c2[w, b] + ngramlm.NU * c1[w] + ngramlm.MU) for w, b, _ in grams.tolist()], atol=1e-3)


def test_ngram_shares_of_unseen_text(spark):
    """Held-out text is likelier than by plain shares and by pairs alone, and trained text likelier still."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    rows = ngramlm.score(docs, TRAINS).collect()
    mean = lambda held, c: sum(r[c] for r in rows if r.held_out == held) / sum(r.n_tokens for r in rows if r.held_out == held)
    assert mean(True, "score") > mean(True, "base_score") + 0.3 and mean(False, "score") > mean(True, "score") + 0.5


def test_ngram_odd(odd, empty):
    rows = ngramlm.score(odd, TRAINS).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 3 for r in rows) == 3
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 3}) == 1 and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert ngramlm.score(empty, TRAINS).count() == 0
    assert {(r.n_known, r.train_tokens) for r in ngramlm.score(odd, "false").collect()} == {(0, 0)}


def test_ngram_shares_sum_to_one():
    """Over all known words and the unknown one, whatever the context."""
    rows = [(0, "a b a c"), (1, "a b b"), (4, "c a")]
    words = ["a", "b", "c", None, "new"]
    one = Counter(w for _, t in rows for w in [*t.split(), None])
    for a, b in (("a", "b"), ("b", "a"), ("c", "c"), ("new", "new")):
        counts = Counter()
        for _, t in rows:
            w = t.split()
            counts.update((tuple(w[i - 1 : i + 1]), [*w, None][i + 1]) for i in range(1, len(w)))
        two = Counter((w[i], [*w, None][i + 1]) for _, t in rows for w in [t.split()] for i in range(len(w)))
        total = sum(one.values()) + len(one) + 1
        top = sum(counts[(a, b), w] + ngramlm.NU * two[b, w] + ngramlm.MU * (one[w] + 1) / total for w in words)
        under = sum(n for (c, _), n in counts.items() if c == (a, b)) + ngramlm.NU * sum(n for (x, _), n in two.items() if x == b) + ngramlm.MU
        assert math.isclose(top, under)


# ---- 5 -------------------------------------------------------------------------------------------------------------


def test_decontamination_in_blocks(spark, docs, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = sorted(decontam.judge(docs, benchmark).collect())
    assert whole == sorted(decontam.judge(docs, benchmark, block=2_000).collect()) and any(r.contaminated for r in whole)
    clean = {r.doc_id for r in whole if not r.contaminated}
    assert {r.doc_id for r in decontam.keep(docs, benchmark).collect()} == clean == {r.doc_id for r in decontam.keep(docs, benchmark, block=2_000).collect()}


def test_phrases_and_proximity(spark, odd, empty):
    docs = spark.createDataFrame([(1, "One two, THREE four five!"), (2, "three two one"), (3, "one x two three"), (4, "one two"), (5, "three four"), (6, None), (7, "")], "doc_id long, text string")
    items = spark.createDataFrame([(10, "one two three"), (11, "four"), (12, ""), (13, None), (14, "One-Two-Three")], "item_id long, text string")
    exact = lambda slop: sorted((r.doc_id, r.item_id, r.position) for r in decontam.matches(docs, items, slop).collect())
    assert exact(0) == [(1, "10", 0), (1, "11", 3), (1, "14", 0), (5, "11", 1)]
    near = exact(1)
    assert {d for d, i, _ in near if i == "10"} == {1, 3}
    judged = {r.doc_id: r for r in decontam.judge(docs, items).collect()}
    assert (judged[1].n_hit, judged[1].n_items, judged[1].items_sha256) == (4, 3, hashlib.sha256(b"10,11,14").hexdigest()) and not judged[4].contaminated
    assert decontam.judge(odd, items).count() == odd.count() and decontam.judge(empty, items).count() == 0
    assert {r.n_hit for r in decontam.judge(odd, items.limit(0)).collect()} == {0}


def test_proximity_ends_with_the_text(spark):
    """However wide the tolerance: terms of two texts that follow each other are no match."""
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta"), (3, "alpha x x x x x x x x x x x gamma")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "alpha gamma"), (2, "beta gamma")], "item_id long, text string")
    for slop in (1, 9, 10, 25):
        assert {r.doc_id for r in decontam.matches(docs, items, slop).collect()} == ({3} if slop > 10 else set())
    assert decontam.matches(docs, items, 0, window=40).count() == 0


def test_an_index_is_kept_and_asked_again(spark, docs, sf_dir, tmp_path):
    """The stored index has all words' postings, and answers benchmarks that weren't known when it was made."""
    decontam.build(docs.repartition(3)).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    rows = [(r.doc_id, decontam.words(r.text)) for r in docs.collect()]
    blocks = [decontam.Index.load(r.asDict()) for r in index.collect()]
    assert sum(int(b.counts.sum()) for b in blocks) == sum(len(w) for _, w in rows) and sum(len(b.lengths) for b in blocks) == len(rows)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for items in (benchmark, docs.where("doc_id % 40 = 3").select(F.col("doc_id").alias("item_id"), "text"), benchmark.limit(0)):
        got = sorted(decontam.judge_in(index, items).collect())
        assert got == sorted(decontam.judge(docs, items).collect())
    windows = {tuple(w[i : i + 10]) for r in benchmark.collect() for w in [decontam.words(r.text)] for i in range(max(1, len(w) - 9)) if w}
    expected = sorted((d, i) for d, w in rows for i in range(len(w)) if any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows}))
    assert sorted({(r.doc_id, r.position) for r in decontam.matches_in(index, benchmark).collect()}) == expected and expected


def test_null_item_ids_as_in_sql(spark):
    import duckdb

    text = "benchmark words that someone has copied into a document as they are"
    documents = spark.createDataFrame([(1, text), (2, "nothing of it"), (3, "four"), (4, f"{text} four")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, text), (10, text), (None, "four"), (11, "unseen words")], "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", documents.toArrow())
    con.register("benchmark", benchmark.toArrow())
    expected = sorted(con.execute(queries.oracle_sql()["op5_decontamination"]).fetchall())
    for block in (decontam.ITEM_BLOCK, 1):
        assert sorted(map(tuple, decontam.judge(documents, benchmark, block=block).collect())) == expected
    assert {r[0]: r[3] for r in expected} == {1: 2, 2: 0, 3: 1, 4: 2}


# ---- 6 -------------------------------------------------------------------------------------------------------------


def test_edits_count_as_if_encoded_anew(own):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ab 's're\n\t  ñ漢12.,'ll") for _ in range(rng.randrange(n)))
    for _ in range(400):
        text = word(rng.choice([5, 50, 400, 4000]))
        tree = recount.Tree.of(text, own)
        for _ in range(rng.randrange(1, 6)):
            start = rng.randrange(len(text) + 1)
            end, new = min(len(text), start + rng.choice([0, 1, 5, 60])), word(rng.choice([1, 4, 30, 300]))
            text = text[:start] + new + text[end:]
            tree.edit(start, end, new)
            assert tree.text() == text and len(tree) == len(own.encode(text)) and tree.chars[1] == len(text)
            assert [t for leaf in tree.leaves for t in leaf] == own.pretokens(text)
            if rng.random() < 0.3:  # stored, and taken up again
                tree = recount.Tree(own, *tree.row())
    long = recount.Tree.of("some words and more " * 20_000, own)
    long.edit(200_000, 200_004, "other")
    assert long.encoded < 200


def test_edit_counts(spark, own, odd, empty):
    text = "mail me@x.org or 10.0.0.1\nsame line\nsame line\ncall 555 123 45678"
    state = recount.build(spark.createDataFrame([(1, text)], "doc_id long, text string"), VOCABULARY)
    for find in (recount.personal, recount.repeated_lines):
        state = recount.apply(recount.with_edits(state, find), VOCABULARY)
    row = recount.counts(state).first()
    after = "mail <redacted> or <redacted>\nsame line\ncall <redacted>"
    assert (row.n_tokens, row.n_edits, row.n_tokens_after, row.n_chars_after, state.first().text) == (len(own.encode(text)), 4, len(own.encode(after)), len(after), after)
    for df in (odd, empty):
        assert recount.counts(recount.apply(recount.with_edits(recount.build(df, VOCABULARY), recount.personal), VOCABULARY)).count() == df.count()
    given = odd.withColumn("edits", F.expr("if(doc_id = 3, null, array(named_struct('start', 0L, 'end', 9999999L, 'text', cast(null as string))))"))
    assert {r.n_tokens_after for r in recount.count(given, VOCABULARY).where("doc_id <> 3 or doc_id is null").collect()} == {0}
    assert recount.count(empty.withColumn("edits", F.expr("cast(null as array<struct<start:long,end:long,text:string>>)")), VOCABULARY).count() == 0


def test_stored_trees_are_edited_again(spark, own, docs, texts, tmp_path):
    """Two rounds on trees that are written in between: counts are those of the whole text, and little is encoded again."""
    recount.build(docs, VOCABULARY).write.parquet(f"{tmp_path}/0")
    after = {i: t or "" for i, t in texts}
    for n, word in enumerate(("first", "second")):
        state = spark.read.parquet(f"{tmp_path}/{n}").withColumn("edits", F.expr(f"array(named_struct('start', length(text) div 2 + 0L, 'end', length(text) div 2 + 3L, 'text', '{word}'))"))
        recount.apply(state, VOCABULARY).write.parquet(f"{tmp_path}/{n + 1}")
        after = {i: t[: len(t) // 2] + word + t[len(t) // 2 + 3 :] for i, t in after.items()}
    state = spark.read.parquet(f"{tmp_path}/2")
    assert {r.doc_id: r.text for r in state.collect()} == after
    got = {r.doc_id: r for r in recount.counts(state).collect()}
    assert {i: r.n_tokens_after for i, r in got.items()} == {i: len(own.encode(t)) for i, t in after.items()}
    assert all(r.n_edits == 2 and r.n_encoded <= 300 for r in got.values()) and sum(r.n_encoded for r in got.values()) < 0.2 * sum(r.n_pretokens for r in got.values())


def test_edit_query_agrees_with_whole_texts(spark, sf_dir, own, texts):
    def edited(text, edits):
        for start, end, new in edits:
            text = text[:start] + new + text[end:]
        return text

    got = {r.doc_id: r for r in queries.op6_edit_counts(spark, sf_dir).collect()}
    for i, t in texts:
        after = edited(t or "", recount.personal(t or ""))
        after = edited(after, recount.repeated_lines(after))
        assert (got[i].n_tokens, got[i].n_tokens_after, got[i].n_chars_after) == (len(own.encode(t or "")), len(own.encode(after)), len(after))


# ---- 7 -------------------------------------------------------------------------------------------------------------


def test_url_rules_and_ratio(spark, sf_dir):
    got = urls.judge(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(got) == len(pages)
    right = total = 0
    for r in got:
        url = pages[r.page_id]
        rest = url.split("://", 1)[1]
        cut = min(rest.find(c) % (len(rest) + 1) for c in "/?#")
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)
        if rule:
            total += 1
            right += (r.score > 0) == (verdict == "allow")
    assert right / total > 0.8


def test_url_odd(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme"), (4, "http://ORG"), (5, "http://a.org/x?y#z"), (6, "x://EXAMPLE.org/es/1://q"), (6, "x://EXAMPLE.org/es/1://q"), (7, "http://com?x"), (8, "http://notorg/"), (None, "http://example.org/en/12")], "page_id long, url string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()]
    assert (5, "a.org", "/x", "org/", "allow") in got and got.count((6, "example.org", "/es/1://q", "example.org/es/", "block")) == 2
    assert (None, "example.org", "/en/12", "example.org/en/1", "block") in got
    assert {(i, h, p, r) for i, h, p, r, _ in got if i in (1, 2, 3, 4, 7, 8)} == {(1, "", "", None), (2, "", "", None), (3, "", "", None), (4, "org", "", None), (7, "com", "", None), (8, "notorg", "/", None)}
    assert urls.judge(df.limit(0)).count() == 0


def test_hosts_and_paths_of_odd_urls(spark):
    rng = random.Random(12)
    urls_ = ["http://shop.com?next=http://x.net/de/a", "http://org#http://z/q", "a://b://c/d?e", "://", "x://", "://Org/de/", "http://COM\n/fr/ü?x", "http:/org/de/"]
    urls_ += ["".join(rng.choice(["://", "/", "?", "#", "a", "ORG", ".", "com", "/de/", "example.org", "/en/1", "http", "\n", "é"]) for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    got = urls.judge(spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")).collect()
    for r in got:
        rest = urls_[r.page_id].partition("://")[2]
        end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].partition("?")[0].partition("#")[0] if rest[end : end + 1] == "/" else ""
        fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, r.verdict)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), urls_[r.page_id]
    by = {urls_[r.page_id]: r for r in got}
    assert [(by[u].host, by[u].path, by[u].rule) for u in urls_[:2]] == [("shop.com", "", None), ("org", "", None)]


def test_url_verdicts_by_plain_dictionaries(spark):
    """Learns, calibrates and judges as the query does, from counters of contexts."""
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    url = {r.page_id: r.url for r in pages.collect()}
    label = {url[i]: "allow" if r.rule in ("org/", "com/fr/") else "block" for i, r in got.items() if r.rule}
    follow = {v: Counter() for v in ("allow", "block")}
    for u, v in label.items():
        if zlib.crc32(u.encode()) % 5:
            m = "\x02" * 4 + u
            follow[v].update((m[i - k : i], m[i]) for i in range(4, len(m)) for k in range(5))
    context = {v: Counter() for v in follow}
    for v, counts in follow.items():
        for (c, _), n in counts.items():
            context[v][c] += n
    letters = len({x for counts in follow.values() for c, x in counts if c == ""}) + 1

    def share(v, c, x):
        shorter = 1 / letters if not c else share(v, c[1:], x)
        return (follow[v][c, x] + urls.MIX * shorter) / (context[v][c] + urls.MIX)

    if not any(len(c) == 0 for c in context["allow"]):
        raise AssertionError

    def score(u):
        m = "\x02" * 4 + u
        return sum(math.log10(share("allow", m[i - 4 : i], m[i]) / share("block", m[i - 4 : i], m[i])) for i in range(4, len(m))) / len(u)

    scores = {i: score(u) for i, u in url.items()}
    assert all(math.isclose(scores[i], got[i].score, abs_tol=1e-9) for i in got)
    held = [(scores[i], label[u]) for i, u in url.items() if u in label and zlib.crc32(u.encode()) % 5 == 0]
    errors = lambda t: sum(s < t for s, v in held if v == "allow") / sum(v == "allow" for _, v in held) + sum(s >= t for s, v in held if v == "block") / sum(v == "block" for _, v in held)
    ruleless = [i for i, r in got.items() if r.rule is None]
    lowest = min((scores[i] for i in ruleless if got[i].verdict == "allow"), default=9.0)
    highest = max((scores[i] for i in ruleless if got[i].verdict == "block"), default=-9.0)
    assert highest < lowest  # one threshold divides them, and none has fewer errors, but for those inside one bin
    step = 2 * urls.SPAN / urls.BINS
    assert min(errors(t) for t in np.arange(highest - step, lowest + step, step / 4)) <= min(errors(s) for s, _ in held) + 1e-9


def test_url_models_learn_from_all_labelled_urls(spark):
    """Scores are those of the counts of all labelled URLs, each once, in lots of any size."""
    pages = [f"http://a{i}.org/w{i % 97}/{i * 7919 % 10007}" for i in range(7000)] + [f"https://b{i}.com/de/{i % 89}?q={i * 31 % 9973}" for i in range(7000)] + [f"http://c{i}.net/{i}" for i in range(500)]
    got = urls.judge(spark.createDataFrame([(i, u) for i, u in enumerate(pages * 2)], "page_id long, url string").repartition(5))
    counts = {"allow": Counter(), "block": Counter()}
    for u in pages[:14_000]:
        if zlib.crc32(u.encode()) % 5:
            m = "\x02" * 4 + u
            counts["allow" if ".org" in u else "block"].update(m[i - k : i + 1] for i in range(4, len(m)) for k in range(5))
    ratio = urls.Ratio(counts)
    rows = got.collect()
    assert sorted(r.page_id for r in rows) == list(range(len(pages) * 2))
    assert max(abs(r.score - ratio.score(pages[r.page_id % len(pages)])) for r in rows) < 1e-9
    lots = urls.in_lots(spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)], "page_id long, url string").repartition(3), 100, 1000)
    most = lots.groupBy("lot").agg(F.count("*").alias("n"), F.sum(F.octet_length("url")).alias("size")).agg(F.max("n"), F.max("size"), F.sum("n")).first()
    assert most[0] <= 100 and most[1] <= 1000 and most[2] == 2000


def test_url_shares():
    grams = {"allow": dict(Counter(g for w in ("abab", "abc") for m in ["\x02" * 4 + w] for i in range(4, len(m)) for g in (m[i - k : i + 1] for k in range(5))))}
    ratio = urls.Ratio(grams)
    for context in ("", "a", "ab", "zz", "\x02\x02\x02\x02"):
        assert math.isclose(sum(ratio.allow.share(context + c) for c in "abc") + ratio.allow.share(context + "?"), 1)
    assert ratio.score(None) == 0 and ratio.score("abab") > ratio.score("cccc")


# ---- 8 -------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(i, f"{f:016x}", least.get(find(n))) for n, ((i, _), f) in enumerate(zip(rows, fps, strict=True))]


@pytest.mark.parametrize("crowd", [simhash.CROWD, 6, 1])  # by pairs, by the other half too, and by single bits
def test_near_copies(spark, crowd):
    rng = random.Random(7)
    base = [rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(300)]
    rows = [(100 - i, " ".join(base[:i] + ["X"] * (i % 3) + base[i:])) for i in range(0, 60)]
    rows += [(200 + i, " ".join(rng.choice("klmnop") + str(rng.randrange(90)) for _ in range(80))) for i in range(40)]
    rows += [(300 + i, t) for i, t in enumerate(ODD)] + [(303, "a"), (None, "a"), (None, "lonely one")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.cluster(df, crowd=crowd).collect()), key=key)
    assert got == sorted(brute_components(rows), key=key)


def test_every_link_shares_a_cell():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 500, dtype=np.int64)
    b = a.view(np.uint64).copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    for x, y in zip(a, b.view(np.int64), strict=True):
        assert {*simhash.cells(np.array([x]))[0].tolist()} & {*simhash.cells(np.array([y]))[0].tolist()}


def test_chains_become_one_component(spark):
    chain = spark.createDataFrame([*((i, i + 1) for i in range(200)), (500, 499), (7, 7), (0, 1)], "a long, b long")
    assert sorted((r.node, r.root) for r in simhash.components(chain).collect()) == [(i, 0) for i in range(201)] + [(499, 499), (500, 499)]
    assert simhash.components(chain.limit(0)).count() == 0


def test_assumed_sizes_stay_small_over_rounds(spark):
    """To Spark a join is as large as the product of its sides, and a checkpoint keeps that: over rounds its digits would multiply."""
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long")
    assumed = lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    found = simhash.stars(chain)
    assert assumed(found) < 1 << 64 and sorted(map(tuple, found.collect())) == [(i, 0) for i in range(1, 101)]
    assert assumed(simhash_similar.contracted(simhash_similar.contracted(found))) < 1 << 512


def brute_roots(fps, bits=4):
    parent = {f: f for f in fps.tolist()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i].view(np.uint64) ^ fps[:i].view(np.uint64)) <= bits):
            a, b = find(int(fps[i])), find(int(fps[j]))
            parent[max(a, b)] = min(a, b)
    return {f: find(f) for f in parent}


@pytest.mark.parametrize("crowd", [1, 4, 40])
def test_links_of_crowded_points(spark, crowd):
    """Random fingerprints and their neighbours within 0 to 6 bits, so crowded that grids go two and three levels deep."""
    rng = np.random.default_rng(9)
    base = rng.integers(-(1 << 63), 1 << 63, 30, dtype=np.int64).view(np.uint64)
    fps = [base]
    for _ in range(25):
        more = base.copy()
        for i in range(len(more)):
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                more[i] ^= np.uint64(1 << int(bit))
        fps.append(more)
    fps = np.unique(np.concatenate(fps)).view(np.int64)
    found = simhash.components(simhash.links(spark.createDataFrame([(int(f),) for f in fps], "fp long"), crowd))
    got = {r.node: r.root for r in found.collect()}
    roots = brute_roots(fps)
    assert {f: got.get(f, f) for f in roots} == roots


def test_a_hundred_thousand_at_one_point(spark):
    """One half's embedding is the same for all: they meet by the other half, in rows that are linear in the members."""
    rng = np.random.default_rng(10)
    low = np.zeros(100_000, dtype=np.uint64)
    for s in range(16):  # one bit of each segment
        low |= np.uint64(1) << (np.uint64(2 * s) + rng.integers(0, 2, len(low)).astype(np.uint64))
    fps = np.unique(low | (rng.integers(0, 1 << 32, len(low)).astype(np.uint64) << np.uint64(32)))
    near = fps[::50] ^ (np.uint64(1) << np.uint64(40)) ^ (np.uint64(3) << np.uint64(2))
    fps = np.unique(np.r_[fps, near])
    cell, who = simhash.subcells(np.full(len(fps[:2000]), int(simhash.embedding(fps[:1], 0)[0] @ simhash._PLACES) * 2), fps[:2000].view(np.int64))
    assert len(cell) <= 545 * 2000
    found = simhash.links(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(4)).collect()
    # Exact: all pairs within 4 bits agree in one of five runs of bits, whatever the grid.
    wanted, values = set(), fps
    for lo, width in ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12)):
        part = (values >> np.uint64(lo)) & np.uint64((1 << width) - 1)
        order = np.argsort(part, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            x, y = np.nonzero(np.triu(np.bitwise_count(values[group][:, None] ^ values[group][None, :]) <= 4, 1))
            wanted |= {frozenset((int(values[group[i]].view(np.int64)), int(values[group[j]].view(np.int64)))) for i, j in zip(x, y, strict=True)}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    def label(pairs):
        parent.clear()
        for a, b in pairs:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        return {x: find(x) for x in list(parent)}

    assert len(wanted) >= 1900 and label(map(tuple, wanted)) == label((r.a, r.b) for r in found)


# ---- 9 -------------------------------------------------------------------------------------------------------------


def test_rules_on_odd_texts(odd, empty):
    rows = {(r.doc_id, r.n_words): r for r in rules.judge(odd).collect()}
    assert rows[0, 0].base_failed and rows[1, 0].base_failed and not rows[1, 0].kept
    assert rows[7, 18_000].n_repeat_words == 18_000 and rows[5, 1].word_chars == 60_000
    assert rules.judge(odd).count() == odd.count() and rules.judge(empty).count() == 0
    assert rules.keep(odd).count() == 0 and rules.keep(odd).columns == odd.columns


def test_rolling_hashes_cover_what_repeats():
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randrange(40))]
        n = rng.randrange(1, 8)
        windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        counts = Counter(windows)
        expected = {p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + n)}
        assert set(np.flatnonzero(rules.repeated(rules.number(words), n))) == expected if len(words) > n else not rules.repeated(rules.number(words), n).any()


# ---- 10 ------------------------------------------------------------------------------------------------------------


def test_shards(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op10_histogram_shards(spark, sf).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    by = {s: [r for r in rows if r.shard == s] for s in range(40)}
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    ideal, largest = sum(r.size for r in rows) / 40, max(r.size for r in rows)
    assert all(abs(sum(r.size for r in own) - ideal) <= largest for own in by.values())
    ends = np.cumsum([sum(r.size for r in by[s]) for s in range(40)])
    assert all(abs(e - ideal * (s + 1)) <= largest / 2 + 1 for s, e in enumerate(ends))


def test_shards_split_a_group_of_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    same = df.withColumn("doc_id", F.lit(1))
    for one in (df, same):
        sizes = [r.b for r in sharding.shard(one, 10).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
        assert len(sizes) == 10 and max(sizes) - min(sizes) <= 2 * 25


def test_shards_odd(odd, empty):
    rows = sharding.shard(odd, 40).collect()
    assert len(rows) == odd.count() and sharding.shard(empty, 40).count() == 0
    assert {r.text_crc32 for r in rows if r.size == 16} == {0} and all(0 <= r.shard < 40 for r in rows)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {r.shard for r in sharding.shard(odd, 1).collect()} == {0}


def test_write_moves_every_row_once(spark, tmp_path):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i // 2}") for i in range(90)] + [(None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sharding.write(df, f"{tmp_path}/out", 5)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    for s in range(5):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots and slots == list(range(len(slots)))


# ---- pipeline ------------------------------------------------------------------------------------------------------


def test_stages(spark, sf_dir, docs, texts, own):
    """Stage by stage; near copies are held against all pairs: none but copies go, and nine tenths of those do."""
    import corpus_pipeline

    model = langid.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"))
    scorer = langid.Scorer(model)
    kept = [(i, t) for i, t in texts if scorer.score(t)[0] != "und" and scorer.score(t)[1] >= corpus_pipeline.LEAST_LANGUAGE_SHARE]
    kept = [(i, t) for i, t in kept if rules.verdict(rules.measure(t)) == (False, None)]
    clean = {r.doc_id for r in decontam.judge(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect() if not r.contaminated}
    at, after = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns, name
        after[name] = sorted(r.doc_id for r in at.select("doc_id").collect())
    assert after["quality"] == sorted(i for i, _ in kept)
    first = {}
    for (i, _), g in zip(kept, groups := alike_groups([t for _, t in kept]), strict=True):
        first[g] = min(i, first.get(g, i))
    assert set(first.values()) <= set(after["near copies"])
    assert len(kept) - len(after["near copies"]) >= 0.9 * (len(kept) - len(set(groups)))
    expected = {i: own.encode(t) for i, t in texts if i in clean and i in set(after["near copies"])}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == expected and 0 < len(got) < len(texts)


def test_stages_on_odd_tables(spark, odd, empty, sf_dir):
    import corpus_pipeline

    odd, empty = (df.withColumnRenamed("shard", "source") for df in (odd, empty))
    for _, stage in corpus_pipeline.STAGES:
        for df in (odd, empty):
            assert stage(spark, df, sf_dir).count() <= df.count()
    assert keep_where(odd, lambda: lambda t: [None] * len(t)).count() == 0


# ---- near copies by similarity -------------------------------------------------------------------------------------


def alike_groups(rows):
    """Number of each row's component by 5-word Jaccard of 0.8 and more, from all pairs that share a shingle."""
    sets = []
    for t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)} if w else set())
    parent, having = list(range(len(rows))), {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in having.get(x, ())) if s else Counter(j for j in range(i) if not sets[j])
        for j, both in met.items():
            if not s or 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
        for x in s:
            having.setdefault(x, []).append(i)
    return [find(i) for i in range(len(rows))]


def test_stage_drops_edited_copies(spark):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for _ in range(40):
        base = [word() for _ in range(200)]
        rows.append(base)
        for edits in (1, 2, 3, 4):  # each changes five shingles of 196: similarity 0.95 to 0.82
            copy = list(base)
            for at in rng.sample(range(5, 195, 10), edits):
                copy[at] = word()
            rows.append(copy)
        rows.append([w if i % 9 else word() for i, w in enumerate(base)])  # no copy: most shingles differ
    texts = [" ".join(r) for r in rows]
    df = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()}
    groups = alike_groups(texts)
    exact = {min(1000 - i for i, g in enumerate(groups) if g == wanted) for wanted in set(groups)}
    assert exact <= kept and len(exact) == 80 and len(kept) <= 80 + 0.1 * 160  # nine of ten edited copies go


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_stage_on_given_documents(spark, sf):
    """Recall over the given documents that are no exact copies, and no document without a copy goes."""
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").repartition(8)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    distinct = list({" ".join((t or "").lower().split()): (i, t) for i, t in rows[::-1]}.values())
    df = spark.createDataFrame(distinct, "doc_id long, text string").repartition(8)
    groups = alike_groups([t for _, t in distinct])
    first = {}
    for (i, _), g in zip(distinct, groups, strict=True):
        first[g] = min(i, first.get(g, i))
    kept = {r.doc_id for r in simhash_similar.keep_first(df).collect()}
    copies = len(distinct) - len(first)
    assert set(first.values()) <= kept and copies >= 5 and len(distinct) - len(kept) >= 0.9 * copies
    assert len(rows) - simhash_similar.keep_first(docs).count() >= 0.95 * (len(rows) - len(first))


def test_recall_at_the_threshold(spark):
    """Of pairs of unrelated bases with a similarity of 0.80 to 0.82, nine in ten are found."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(300):
        base = [word() for _ in range(226)]  # 222 shingles, of which 24 change in 5 places (one of them at an end): 198 / 246
        copy = list(base)
        for at in (*[20 + 40 * i for i in range(4)], 222):
            copy[at] = word()
        texts += [" ".join(base), " ".join(copy)]
    groups = alike_groups(texts)
    assert len(set(groups)) == 300
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert simhash_similar.keep_first(df).count() <= 300 + 0.1 * 300


@pytest.mark.parametrize("block", [7, 512])
def test_families_in_blocks(spark, block, monkeypatch):
    """A family whose members are just under and just over the threshold, whole and in pairs of blocks: its exact components."""
    monkeypatch.setattr(simhash_similar, "BLOCK", block)
    rng = random.Random(19)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, texts = [word() for _ in range(200)], []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(5, 195, 5), 3 + i % 3):
            copy[at] = word()
        texts.append(" ".join(copy))
    groups = alike_groups(texts)
    assert 3 < len(set(groups)) < 60
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, own_digest string").repartition(4)
    kept = simhash_similar.keep_first(df)
    assert kept.columns == df.columns and len(set(groups)) <= kept.count() <= len(set(groups)) + 3


def test_overlaps_of_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, n).astype(np.uint64)) for n in (1, 50, 300, 300, 2, 120)] + [np.array([10**6], np.uint64)]
    assert (simhash_similar.overlaps(sets) - np.diag(np.diag(simhash_similar.overlaps(sets))) == [[0 if i == j else len(np.intersect1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]).all()


def test_a_dense_group_of_near_copies(spark):
    """More members than a point pairs off: links to leaders, then blocks of one family."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    rows = [list(base)]
    for _ in range(400):
        copy = list(base)
        for at in rng.sample(range(300), 2):
            copy[at] = word()
        rows.append(copy)
    rows += [[word() for _ in range(40)] for _ in range(50)]
    df = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in simhash_similar.keep_first(df).collect())
    assert kept == [0, *range(401, 451)]
    words = np.unique([simhash_similar.long_fingerprint(simhash_similar.shingles(" ".join(r)))[0] for r in rows[:401]])
    leader = simhash_similar._leaders(words)
    assert np.bincount(leader).max() > simhash_similar.DENSE and (np.bitwise_count(words ^ words[leader]) <= simhash_similar.CLOSE).all()
    near = {(int(a), int(b)) for x, y in simhash_similar._near(words) for a, b in zip(x, y, strict=True)}
    assert near == {(i, j) for i in range(len(words)) for j in range(i) if int(words[i] ^ words[j]).bit_count() <= simhash_similar.NEAR}


def test_pairs_of_known_families_are_left_out(spark, monkeypatch):
    """In small and in dense points pairs between families stay, those within one don't; a large group leaves few links in all."""
    rng = np.random.default_rng(5)
    for n in (6, 40):
        word = rng.integers(0, 1 << 63)
        words = np.array([word ^ (1 << int(i)) for i in rng.permutation(63)[:n]], np.int64)
        family = np.array([1, 2, 0] * n, np.int64)[:n]
        batch = lambda f: pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64)), pa.array(words), pa.array(f)], ["cell", "word", "family"])  # noqa: E731, B023
        links = lambda f: [(a, b) for r in simhash_similar._meet(iter([batch(f)])) for a, b in zip(*(r.column(c).to_pylist() for c in "ab"), strict=True)]  # noqa: E731, B023
        of = dict(zip(words.tolist(), family.tolist(), strict=True))
        assert links(family) and all(of[a] != of[b] or not of[a] for a, b in links(family))
        assert links(np.zeros(n, np.int64)) and not links(np.ones(n, np.int64))
    seen = []
    monkeypatch.setattr(simhash_similar, "contracted", lambda edges, own=simhash_similar.contracted: seen.append(edges.count()) or own(edges))
    rnd = random.Random(23)
    new = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base, texts = [new() for _ in range(120)], []
    for _ in range(500):
        copy = list(base)
        copy[rnd.randrange(120)] = new()
        texts.append(" ".join(copy))
    assert simhash_similar.keep_first(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).count() == 1
    assert len(seen) == 2 and sum(seen) < 40 * 500


def test_rows_of_a_point_grow_with_its_members():
    """Members that are all near each other, but few within a leader's reach: no more rows than members at either pass, at any
    size, and what is dealt again with all bits has the components that all near pairs have."""
    rng = np.random.default_rng(41)
    bits = lambda n, k: np.bitwise_or.reduce(np.uint64(1) << rng.permuted(np.tile(np.arange(63, dtype=np.uint64), (n, 1)), axis=1)[:, :k], axis=1)
    for n in (100, 800):
        words = np.unique(bits(n, 8))
        for family in (np.zeros(len(words), np.int64), rng.integers(0, 4, len(words)), np.r_[0, np.ones(len(words) - 1, np.int64)]):
            batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(words), np.int64)), pa.array(words.view(np.int64)), pa.array(family)], ["cell", "word", "family"])
            pairs = np.bitwise_count(words[:, None] ^ words[None, :]) <= simhash_similar.NEAR
            pairs &= (family[:, None] != family[None, :]) | (family[:, None] == 0)
            np.fill_diagonal(pairs, False)
            assert 0 < sum(r.num_rows for r in simhash_similar._meet(iter([batch]))) <= len(words)
            rows = [r for b in simhash_similar._cross(iter([batch])) for r in b.to_pylist()]
            assert len(rows) <= len(words)
            if pairs.sum() // 2 > len(words):  # each member of a pair, with its point
                assert {r["a"] for r in rows} == set(words[pairs.any(axis=1)].view(np.int64).tolist()) and all(r["b"] is None and r["outer"] == 0 for r in rows)
            else:
                at = {int(w): i for i, w in enumerate(words.view(np.int64))}
                assert {frozenset((at[r["a"]], at[r["b"]])) for r in rows} == {frozenset(map(int, x)) for x in zip(*np.nonzero(pairs), strict=True)}
    for groups in (1, 60, 300):
        bases = rng.integers(0, 1 << 63, (groups, simhash_similar.WORDS64)).astype(np.uint64)
        prints = bases[rng.integers(0, groups, 300)] ^ bits(300 * simhash_similar.WORDS64, 8).reshape(300, -1)
        group = np.r_[np.zeros(5, np.int64), np.arange(1, 296)]
        a, b = simhash_similar.tree(prints, group)
        near = sum(np.bitwise_count(prints[:, None, j] ^ prints[None, :, j]).astype(int) for j in range(simhash_similar.WORDS64)) <= simhash_similar.NEAR_ALL * 512
        near |= group[:, None] == group[None, :]
        links = np.eye(300, dtype=bool) | (group[:, None] == group[None, :])
        assert near[a, b].all() and len(a) < 296
        links[a, b] = links[b, a] = True
        for _ in range(9):
            near, links = near.astype(np.float32) @ near > 0, links.astype(np.float32) @ links > 0
        assert (near == links).all()


def test_stage_keeps_one_row_of_null_and_repeated_ids(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(None, "a b"), (None, "A  b"), (None, "a b"), (1, "c d"), (1, "e f"), (1, "c d"), (2, None), (3, "")], "doc_id long, text string")
    df = df.select("doc_id", "text", F.lit(1).alias("id"), F.lit("x").alias("digest"), F.lit("y").alias("n"))
    got = corpus_pipeline.near_copies(spark, df, "")
    assert got.columns == df.columns
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert [(i, t) for i, t in rows if i is not None] == [(1, "c d"), (1, "e f"), (2, None)] and [t.lower().split() for i, t in rows if i is None] == [["a", "b"]]
    assert corpus_pipeline.near_copies(spark, df.limit(0), "").count() == 0


def test_points_are_dealt_in_few_rows(spark):
    """A text has under 11 rows a half on average instead of 25, and tasks make all its points of them: the same texts meet as by all points."""
    rng = np.random.default_rng(31)
    prints = rng.integers(-(1 << 63), 1 << 63, (400, simhash_similar.WORDS64))
    prints[200:] = prints[:200] ^ np.int64(0b101) ^ (np.int64(1) << rng.integers(8, 62, (200, 1)))
    batch = pa.RecordBatch.from_arrays([pa.array(prints.tolist(), pa.list_(pa.int64())), pa.array(np.arange(400))], ["fp", "family"])
    dealt = list(simhash_similar._spread(range(1, 3))(iter([batch])))
    assert sum(b.num_rows for b in dealt) < 11 * 2 * 2 * 400
    points, where = {}, {}
    rows = spark.createDataFrame(pa.Table.from_batches(dealt).to_pandas())
    for at, cell, word, who in simhash_similar.opened(rows.withColumn("family", F.struct("at", "family"))).select("family.at", "cell", "word", "family.family").collect():
        points.setdefault(cell, []).append(who)
        assert word in prints[who]
        assert where.setdefault(cell, at // (2 * simhash_similar._INNER)) == at // (2 * simhash_similar._INNER)
    want = {}
    for j in (1, 2):
        for cell, who in zip(*simhash.cells(prints[:, j], np.arange(400), j), strict=True):
            want.setdefault(int(cell), []).append(int(who))
    assert sorted(map(sorted, points.values())) == sorted(map(sorted, want.values())) and max(map(len, want.values())) > 1


def test_long_fingerprints_by_plain_counts():
    for text in ("a b c d e f g", "one", " ".join(map(str, range(700)))):
        own = simhash_similar.shingles(text)
        for j, value in enumerate(simhash_similar.long_fingerprint(own)):
            hashes = []
            for h in own.tolist():
                h = (h ^ h >> 32) * int(simhash_similar._ODD[j]) % (1 << 64)
                hashes.append(h ^ h >> 29)
            assert int(value) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_personal_data_is_looked_for_where_it_can_be():
    """Lines without an @ or enough digits are passed over, and a long word costs no more than its length."""
    rng, parts = random.Random(9), ["a.b+c@d-e.org", "@", "1.22.3.4", "12 345-678 9", "0123456789", "deadbeef" * 4, "١" * 9, "word", "x-1", " ", " ", "\n", " ", ".", "-", "a@b.c+x@y.zz"]
    for _ in range(3000):
        text, plain, at = "".join(rng.choices(parts, k=rng.randrange(12))), [], 0
        for line in text.splitlines(keepends=True):
            plain += [(at + m.start(), at + m.end(), "<redacted>") for m in recount._PERSONAL.finditer(line)]
            at += len(line)
        assert recount.personal(text) == plain[::-1]
    start = time.process_time()
    assert recount.personal("xy" * 50_000) == [] and time.process_time() - start < 5


def test_language_tables_of_tasks_are_arrays():
    """A task holds a hash and the shares of a gram and no text of it, and finds the same rows, also past the last hash."""
    grams = [f"w{i}" for i in range(5000)]
    model = {"langs": ["a", "b"], "grams": {0: grams} | {k: [] for k in langid.ORDERS}, "shares": {0: np.arange(10_000.0).reshape(-1, 2)} | {k: np.zeros((0, 2)) for k in langid.ORDERS}, "floors": dict.fromkeys((0, *langid.ORDERS), -9.0)}
    sent = langid.packed(model)
    assert len(pickle.dumps(sent)) < 5000 * (8 + 2 * 8) + 2000
    scorer = langid.Scorer(sent)
    assert [x.tolist() for x in scorer.words(grams[::-1])] == model["shares"][0][::-1].tolist()
    assert scorer.words([f"x{i}" for i in range(500)]) == [None] * 500
