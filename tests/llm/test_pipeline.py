"""The pipeline beside a plain version, and the queries as the driver calls them."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from stormledger.llm import mixing
from stormledger.llm.oracle import oracle_sql
from stormledger.llm.queries import queries

from .helpers import awkward, documents, none, prose
from .test_lines import plain as plain_lines
from .test_neardup import altered
from .test_neardup import plain as plain_groups


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(9)
    item = prose(rnd, 30).capitalize()
    texts = ["\n".join(prose(rnd, 25) for _ in range(3)) for _ in range(25)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(100, texts[0], "en", "s0"), (101, "new words here first\n" + texts[1].split("\n")[0], "en", "s1")]
    rows += [(102 + i, altered(rnd, texts[2].replace("\n", " "), 0.01), "en", "s2") for i in range(4)]
    rows += [(110, f"{prose(rnd, 20)} {item} {prose(rnd, 20)}", "en", "s1"), (111, "12 34 !!", "en", "s1"), (112, None, "en", "s1")]
    folder = tmp_path_factory.mktemp("sf")
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_equals_a_plain_version(spark, tables):
    folder, rows = tables
    found = {r["doc_id"]: r["text"] for r in P.run(spark, folder).collect()}
    texts = {d: t for d, t, *_ in rows if any(map(str.isalpha, t or ""))}
    after = plain_lines(list(texts.items()), 20)
    after = {d: t for d, t in after.items() if t.strip() or t == texts[d]}
    component, _ = plain_groups(list(after.items()))
    after = {d: t for d, t in after.items() if component[d] == d}
    assert 100 not in after and len([d for d in after if 102 <= d < 106]) == 1
    del after[110]
    meta = {r[0]: r for r in rows}
    kept = mixing.mixed(documents(spark, [(d, t, *meta[d][2:4]) for d, t in after.items()])).where("kept").select("doc_id").collect()
    assert found == {r[0]: after[r[0]] for r in kept}


def test_stages_keep_columns_and_take_awkward_rows(spark, tables):
    folder, _ = tables
    for docs in (awkward(spark), none(spark)):
        for _, stage in P.STAGES:
            changed = stage(spark, docs, folder)
            assert changed.columns == docs.columns
            docs = changed
    assert docs.count() == 0


def test_every_operator_is_registered_with_its_oracle():
    made = entry.queries()
    assert [n for n in range(1, 11) if sum(q.startswith(f"op{n}_") for q in made) != 1] == []
    assert "pipeline" in made and set(queries()) <= set(made)
    assert set(oracle_sql()) <= set(entry.oracle_sql()) <= set(made)
