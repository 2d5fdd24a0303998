"""The registered queries against SQL, and the pipeline against plain Python stage by stage."""

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_texts import contained, groups, removed
from tokenizers import Tokenizer

import corpus_pipeline
from cartulary.llm.queries import ORACLES, QUERIES

TABLES = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not TABLES.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    duck = duckdb.connect()
    for table in TABLES.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    found = QUERIES[name](spark, str(TABLES))
    cursor = duck.execute(ORACLES[name])
    columns = sorted(item[0] for item in cursor.description)
    assert columns == sorted(found.columns)
    theirs = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(theirs)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].partition("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = np.random.default_rng(21)
    words = {"xx": [f"alba{k} morin{k % 7}" for k in range(400)], "yy": [f"grüth{k} schpek{k % 5}" for k in range(400)]}
    passage = " ".join(f"shared{k} piece{k}" for k in range(40))
    item = " ".join(f"item{k}" for k in range(12))
    rows = []
    for k in range(160):
        lang = "xx" if k % 3 else "yy"
        text = " ".join(draw.choice(words[lang], int(draw.integers(2, 120))))
        if k % 10 == 1:
            text += " " + passage + " " + " ".join(draw.choice(words[lang], 90))
        if k % 16 == 2:
            text += " " + item + " the end of it"
        rows.append([k, text, lang, "s", len(text)])
    for k in range(160, 175):  # near copies
        rows.append([k, rows[k - 100][1] + " changed", rows[k - 100][2], "s", 0])
    rows += [[175, None, None, "s", None], [176, "", None, "s", 0], [177, "12 34 -- 56", None, "s", 11], [178, rows[5][1], rows[5][2], None, 3]]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), [(r[0], r[1] or "") for r in rows], item


def test_pipeline_equals_its_stages_in_plain_python(spark, folder):
    path, texts, item = folder
    known = [(k, t) for k, t in texts if any(x.isalpha() for x in t)]
    first = {key: component for (key, _, component), n in groups(known, 5, 80).items() for _ in range(n)}
    single = [(k, t) for k, t in known if first[k] == k]
    assert len(single) < len(known) < len(texts)
    spans = removed([t for _, t in single], corpus_pipeline.REPEATED_BYTES)
    assert any(gone for _, gone, _, _ in spans)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = stages["language"](spark, docs, path)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in known)
    one = stages["near copies"](spark, kept, path)
    assert sorted((r.doc_id, r.text) for r in one.collect()) == sorted(single)
    cut = stages["repeated strings"](spark, one, path)
    left = {r.doc_id: r.text for r in cut.collect()}
    assert {k: len(t.encode()) for k, t in left.items()} == {k: s[0] - s[1] for (k, _), s in zip(single, spans, strict=True)}
    dirty = {key for key, *_ in contained(left.items(), [(0, item)])}
    assert dirty
    clean = stages["decontamination"](spark, cut, path)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(left) - dirty)
    for frame in (kept, one, cut, clean):
        assert frame.columns == docs.columns
    packed = corpus_pipeline.run(spark, path).collect()
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path(corpus_pipeline.TOKENIZER)))
    expected = Counter()
    for key in set(left) - dirty:
        ids = np.array(tokenizer.encode(left[key], add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            expected[key, n, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected


def test_repeated_passage_of_short_words(spark):
    draw = np.random.default_rng(31)
    passage = " ".join("".join(draw.choice(list("abcdefgh"), 1 + k % 3)) for k in range(51))
    assert len(passage) < corpus_pipeline.REPEATED_BYTES
    rows = [(k, " ".join(f"own{k}word{n}" for n in range(60)) + f" before{k} {passage} after{k}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.remove_repeated_strings(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in left} == {k: t.replace(passage, "") for k, t in rows}


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
