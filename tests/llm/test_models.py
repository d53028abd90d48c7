"""Operators that SQL cannot express: held-out accuracy, exact round trips, planted cases, the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from linkscore.llm import decontaminate, language, pii, quality
from tests.llm import cases

SF = "/root/testdata/sf0.01"
KEY = b"a key of the tests"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(cases.documents(), cases.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], cases.SCHEMA)


def test_quality_on_rows_not_learnt_from(spark, corpus):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    model = quality.fit(corpus, labels.where(learn))
    truth = labels.where(~learn).select("doc_id", F.col("quality").alias("truth"))
    out = quality.score(corpus, model).join(truth, "doc_id").toPandas()
    good, bad = out[out.truth == 1], out[out.truth == 0]
    assert good[~good.base_failed].kept.all() and bad.kept.mean() < 0.1
    # the model by itself, where the plain rules see nothing
    unseen = bad[~bad.base_failed]
    assert len(unseen) > 5 and unseen.kept.mean() < 0.2


def test_quality_without_labels(spark, small, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.quality_rules(small, labels)
    assert out.where("kept = base_failed").count() == 0
    assert quality.quality_rules(none, labels).count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0), (4, 1, 0), (4, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in quality.label_sample(odd).collect()] == [(5, 1)]
    assert quality.quality_rules(small, odd).count() == small.count()


def test_language_on_held_out_rows(corpus):
    held = language.id_bucket(F.col("doc_id"), 4) == 2
    out = language.identify(corpus, language.learn(corpus.where(~held))).where(held)
    told = out.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.avg(F.col("rejected").cast("double"))).first()
    assert told[0] > 0.98 and told[1] < 0.02
    assert out.where("score < 0 OR score > 1").count() == 0


def test_language_by_hand(corpus):
    """Sizes, languages and scores as plain compression with the same dictionaries gives them."""
    dictionaries = language.learn(corpus)
    rows = language.identify(corpus.limit(60), dictionaries).collect()
    packers = {
        lang: zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), level=language.LEVEL, write_content_size=False, write_dict_id=False)
        for lang, raw in sorted(dictionaries.items())
    }
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        raw = language.plain(r.text).encode()
        sizes = sorted((sum(len(p.compress(raw[i : i + language.FRAME_BYTES])) for i in range(0, len(raw), language.FRAME_BYTES)), lang) for lang, p in packers.items())
        lead = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert (r.lang_pred, r.rejected) == (sizes[0][1], lead < language.MIN_MARGIN)
        assert r.score == pytest.approx(lead)


def test_language_edges(small, none):
    out = language.identify(small, language.learn(small))
    assert out.columns == [*small.columns, "lang_pred", "score", "rejected"]
    unknown = {r.doc_id for r in out.where("lang_pred = 'und'").collect()}
    assert unknown == {1000, 1001, 1002, 1007}
    assert out.where("lang_pred = 'und' AND (score <> 0 OR NOT rejected)").count() == 0
    clash = language.identify(small.withColumn("score", F.lit("x")).withColumn("rejected", F.lit(1)), {})
    assert clash.where("lang_pred <> 'und'").count() == 0 and clash.count() == small.count()
    assert language.learn(none) == {}
    assert language.identify(none, {"en": b"abc"}).count() == 0


def test_copies_do_not_crowd_out_a_language(spark):
    """Every text of a rare language is learnt, from its beginning to its end, however often one is copied."""
    names = "abcdefghijklmnopqrst"
    rows = [("copied words only", "aa")] * 4000 + [(f"rare text {c * 9} " + "filler " * 500 + c * 8, "aa") for c in names]
    rows += [("some other words", "bb")] * 30_000 + [("one text " + "and more " * 20_000 + "finis", "cc")] * 3000
    found = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert set(found) == {"aa", "bb", "cc"}
    words = set(found["aa"].decode().split())
    assert {"copied", *(c * 9 for c in names), *(c * 8 for c in names)} <= words
    assert len(found["cc"]) >= language.DICTIONARY_BYTES - 100 and found["cc"].endswith(b"finis")
    assert found["bb"] == b"some other words"


def test_id_bucket_is_crc32_of_the_text(small):
    for d, b in {(r[0], r[1]) for r in small.select("doc_id", language.id_bucket(F.col("doc_id"), 7)).collect()}:
        assert b == zlib.crc32(("" if d is None else str(d)).encode()) % 7


ITEMS = [
    (1, "Which river of the old land runs north past the three grey towers? The long cold Elbe runs there"),
    (2, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (3, None),
    (4, ""),
    (None, "no id"),
    (2, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (5, "short item"),
]


def test_contaminated(spark, small, none, monkeypatch):
    words = " ".join(f"w{i}" for i in range(300))
    texts = [
        (10, f"{words} {ITEMS[0][1]} {words}"),
        (11, f"{words} {ITEMS[0][1].upper().replace('?', ' ...')}"),
        (12, "Which river of the old land runs north past the three grey towers? nobody knows " + words),  # no answer
        (13, f"{words} five six seven eight nine ten eleven twelve thirteen fourteen"),  # lacks much of the question
        (14, ITEMS[1][1]),
        (15, words),
        (16, None),
        (17, ""),
        (None, ITEMS[1][1] + " " + ITEMS[0][1]),
        (14, ITEMS[1][1]),
        (18, "very short item here"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == Counter({(10, 1): 1, (11, 1): 1, (13, 2): 1, (14, 2): 2, (None, 1): 1, (None, 2): 1, (18, 5): 1})
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {12, 15, 16, 17}
    shards, more = zip(*decontaminate.index_shards(bench, shard_postings=5))
    assert len(shards) > 1 and list(more) == [True] * (len(shards) - 1) + [False]
    assert sorted(x for s in shards for x in s.ids) == [1, 2, 5]
    monkeypatch.setattr(decontaminate.index_shards, "__defaults__", (5,))  # several shards, one after the other
    assert Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == got
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()} == {12, 15, 16, 17}
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("item_id > 99")).count() == 0
    assert decontaminate.decontaminate(docs, bench.where("item_id > 99")).count() == len(texts)


def test_retrieval_skips_nothing():
    """The three steps find the same as scoring every passage against every item."""
    rng = np.random.default_rng(11)
    vocabulary = rng.integers(0, 2**63, 80, dtype=np.uint64)
    rows = []
    for i in range(70):
        words = vocabulary[rng.integers(0, 80, rng.integers(1, 30))].astype(np.int64)
        terms = np.unique(words)
        weights = rng.random(len(terms))
        rows.append({"item_id": i, "words": words.tolist(), "split": 1, "terms": terms.tolist(), "weights": (weights / weights.sum()).tolist()})
    index = decontaminate.build(rows)
    for _ in range(20):
        lengths = rng.integers(0, 120, 6)
        first = np.concatenate([[0], np.cumsum(lengths)])
        hashes = rng.choice(np.append(vocabulary, rng.integers(0, 2**63, 20, dtype=np.uint64)), first[-1])
        words = type("W", (), {"first": first, "hash": hashes})
        place = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
        term = np.where(index.terms[place] == hashes, place, -1)
        for level in index.levels:
            got = Counter(zip(*(np.round(x, 9).tolist() for x in decontaminate.retrieve(level, words, term, 0.5))))
            want = Counter()
            size = level.segment
            for text, n in enumerate(lengths.tolist()):
                n_segments = -(-n // size)
                for s in range(max(n_segments - 1, min(n_segments, 1))):
                    held = set(hashes[first[text] + s * size : min(first[text + 1], first[text] + (s + 2) * size)].tolist())
                    for k, number in enumerate(level.items.tolist()):
                        own = next(r for r in rows if r["item_id"] == index.ids[number])
                        score = sum(w for t, w in zip(own["terms"], own["weights"]) if t in held)
                        if score >= 0.5 - 1e-9:
                            want[text, float(first[text] + s * size), k, round(score, 9)] += 1
            assert got == want


def test_planted_items_are_found(spark, corpus):
    items = [(r.item_id, " ".join(r.text.split())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(corpus, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    for r in corpus.collect():
        text = " ".join(r.text.split())
        assert {(r.doc_id, i) for i, t in items if t in text} <= found


VALUES = [
    "4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000",
    "123-45-6789", "+1 (323) 555-9830", "212-555-0187", "+49 30 901820 11", "10.0.0.1", "2024-02-29", "31.12.1999", "12/25/2001",
    "1/2/2003", "anna.b1@mail.example.org",
]


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_round_trip(value):
    text = f"so, {value} ends"
    new, found = pii.pseudonymise(text, KEY)
    assert len(found) == 1 and new != text
    assert [a.isdigit() for a in new if a in " -.()+/@,"] == [a.isdigit() for a in text if a in " -.()+/@,"]
    again, kinds = pii.pseudonymise(new, KEY, back=True)
    assert again == text and [k for _, _, k in kinds] == [k for _, _, k in found]
    assert pii.pseudonymise(text, key=b"other")[0] != new


CARD, IBAN, GROUPED = "4111 1111 1111 1111", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (f"IBAN {IBAN} BIC COBADEFFXXX", [IBAN]),
        (f"{GROUPED} EUR 500", [GROUPED]),
        (f"AB12 {IBAN} 7", [IBAN]),
        (f"{IBAN} {GROUPED}", [IBAN, GROUPED]),
        (f"{CARD} 12/27", [CARD]),
        ("4111111111111111 123", ["4111111111111111"]),
        (f"no 12 {CARD}", [CARD]),
        (f"{CARD} 5500-0000-0000-0004 12", [CARD, "5500-0000-0000-0004"]),
        ("41111111 11111111 27", ["41111111 11111111"]),
        (f"2024-01-05 {CARD}", ["2024-01-05", CARD]),
        ("2024-01-05T10:00:00Z", ["2024-01-05"]),
    ],
)
def test_values_beside_others(text, values):
    new, found = pii.pseudonymise(text, KEY)
    assert [text[a:b] for a, b, _ in found] == values
    alone = [pii.pseudonymise(v, KEY)[0] for v in values]
    assert [new[a:b] for a, b, _ in found] == alone and not set(alone) & set(values)
    assert pii.pseudonymise(new, KEY, back=True) == (text, found)


def test_crowded_numbers_round_trip():
    """Whatever stands side by side, the new text is read like the old one and can be undone."""
    rng = np.random.default_rng(5)
    parts = [*VALUES, CARD, IBAN, GROUPED, "AB12", "EUR", "NO93", "x"]
    for _ in range(1500):
        words = [parts[rng.integers(len(parts))] if rng.random() < 0.4 else str(rng.integers(10 ** rng.integers(1, 6))) for _ in range(rng.integers(2, 9))]
        text = "".join(w + " -/,"[rng.choice(4, p=[0.7, 0.1, 0.1, 0.1])] for w in words)
        new, found = pii.pseudonymise(text, KEY)
        again, kinds = pii.pseudonymise(new, KEY, back=True)
        assert again == text and [k for _, _, k in kinds] == [k for _, _, k in found]


def test_equal_values_stay_linked():
    a, b = pii.pseudonymise("4111 1111 1111 1111", KEY)[0], pii.pseudonymise("x 4111-1111-1111-1111", KEY)[0]
    assert a.replace(" ", "") == b[2:].replace("-", "")
    assert pii.luhn_digit(a.replace(" ", "")[:-1]) == a[-1]


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "2023-02-29", "300.1.2.3", "000-12-3456", "GB82 WEST 1234 5698 7654 33", "v1.2.3.4.5", "12345678", "a@b", ""])
def test_invalid_values_stay(text):
    assert pii.pseudonymise(text, KEY) == (text, [])


def test_feistel_is_a_permutation():
    for size in (1, 2, 3, 10, 97, 1000):
        net = pii.Feistel(b"k", size, "t")
        image = [net.permute(i) for i in range(size)]
        assert sorted(image) == list(range(size)) and [net.permute(i, back=True) for i in image] == list(range(size))


def test_pseudonyms_of_documents(spark, corpus, small, none):
    out = pii.pseudonymise_documents(corpus, KEY)
    undone = pii.pseudonymise_documents(out, KEY, back=True)
    assert undone.join(corpus, ["doc_id", "text"]).count() == corpus.count()
    assert out.join(corpus, ["doc_id", "text"]).count() == out.where("n_replaced = 0").count() < corpus.count()
    assert pii.pseudonymise_documents(small, KEY).where("text IS NULL").count() == 1
    assert pii.pseudonymise_documents(none, KEY).count() == 0


def test_pipeline_stages(spark, tmp_path, corpus):
    """Every stage against its own input by brute force; awkward rows pass through all of them."""
    rows = cases.documents(n=40)
    base = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = corpus.limit(60).unionByName(base)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = before, [tuple(r) for r in docs.collect()]
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = kept["language_id"]
    assert not Counter(after) - Counter(before)
    assert all(any(c.isalpha() for c in t or "") for _, t, *_ in after)
    before, after = kept["line_dedup"]
    assert Counter((d, t) for d, t, *_ in after) == Counter((d, t) for (d, t, _, _), n in cases.line_dedup(before).items() for _ in range(n))
    before, after = kept["near_duplicates"]
    want = {c for _, _, c in cases.jaccard_components(before, 5, 80)}
    assert {r[0] for r in after} == want
    before, after = kept["decontamination"]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    assert Counter(after) == Counter(r for r in before if not any(t in " ".join((r[1] or "").split()) for t in items))
    before, after = kept["mixing"]
    assert Counter((r[0], r[1]) for r in after) == Counter((r[0], len(cases.words(r[1]))) for r in before)
    (tmp_path / "empty").mkdir()
    spark.createDataFrame([], base.schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/empty/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
