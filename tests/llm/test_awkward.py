"""Every operator on an empty table, repeated rows, very long texts and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from linkscore.llm import decontaminate, jaccard, language, lexical, lines, merkle, mixing, pii, ppm, quality, secrets, substrings

LONG = [
    "x" * 2_000_000,
    "same " * 200_000,
    "\n".join(f"line {i} of a long log, at 10.0.{i % 250}.{i % 199}" for i in range(30_000)),
    " ".join(f"w{(i * i) % 7919}" for i in range(300_000)),
    "password=" + "a1" * 300_000 + "\n" + "AKIA" * 50_000,
]
ROWS = [(i, t, "en", "a") for i, t in enumerate(LONG)] + [(7, None, "en", None), (8, "", None, "a"), (9, " \n\t", "de", "b"), (10, "one line", "de", "b")]
ROWS += [(10, "one line", "de", "b"), (10, "another text", "de", "b"), (None, "one line", "en", "a"), (None, None, None, None), *[(11, LONG[2], "en", "a")] * 2]
CLASH = (
    "quality kept n_words base_failed node root key keys size target taken shard digest block row rank row_id part word ctx sym score "
    "held_out lang_pred rejected spans id pos print own lines drops n_lines n_dropped n_shingles component_id item_id label total path"
).split()


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit(1) for c in CLASH}).repartition(4).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0, 1, 2) for i in range(12)], "doc_id long, quality int, toxic int, text int, kept int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "what is one line? another text of an item", 5), (None, "x", 5), (2, None, 5)], "item_id long, text string, doc_id int")


OPERATORS = {
    "quality": lambda docs, labels, bench: quality.quality_rules(docs, labels),
    "jaccard": lambda docs, labels, bench: jaccard.jaccard_components(docs),
    "lines": lambda docs, labels, bench: lines.dedup_lines(docs),
    "secrets": lambda docs, labels, bench: secrets.scan(docs),
    "language": lambda docs, labels, bench: language.identify(docs, language.learn(docs)),
    "clean": lambda docs, labels, bench: decontaminate.decontaminate(docs, bench),
    "pii": lambda docs, labels, bench: pii.pseudonymise_documents(docs, b"key"),
    "mixing": lambda docs, labels, bench: mixing.mix(docs),
    "substrings": lambda docs, labels, bench: substrings.remove_repeated(docs),
    "ppm": lambda docs, labels, bench: ppm.score_documents(docs),
    "merkle": lambda docs, labels, bench: merkle.manifest_proofs(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(odd, labels, bench, name):
    out = OPERATORS[name](odd, labels, bench)
    assert len(set(out.columns)) == len(out.columns)
    rows = out.select("doc_id").collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows) == sorted((r[0] is None, r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_none_of_none(odd, labels, bench, name):
    assert OPERATORS[name](odd.limit(0), labels, bench).count() == 0


def test_search_in_long_texts(odd, bench):
    found = {(r.item_id, r.rank, r.doc_id) for r in lexical.search(odd, bench).collect()}
    assert (1, 1, 10) in found and all(item == 1 or item is None for item, _, _ in found)


def test_equal_rows_have_equal_answers(odd, labels, bench):
    for name in ("quality", "secrets", "language", "pii", "merkle"):
        out = OPERATORS[name](odd.where("doc_id = 11"), labels, bench)
        assert out.count() == 2 and out.distinct().count() == 1
