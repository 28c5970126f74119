"""Null and repeated ids: rows are known by what they hold, in near-dedup, decontamination and mixing."""

import glob
import os
import random
from collections import Counter
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from apronlake.llm import decontaminate, near_dedup, shared


def _say(r, n):
    return " ".join(f"w{r.randrange(400)}" for _ in range(n))


def _near(text):
    w = text.split()
    return " ".join([*w[:-1], "edited"])


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(1)
    a, b, c = _say(r, 100), _say(r, 100), _say(r, 100)
    rows = [(1, a), (1, b), (2, _near(a)), (3, _near(b)), (None, c), (None, _near(c)), (None, ""), (7, None), (8, _say(r, 60)), (8, _say(r, 60))]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"at": F.lit("clash"), "digest": F.lit(1), "source": F.lit("s")})


def test_near_dedup_links_by_text(odd):
    got = {(r.at, r.digest): r for r in near_dedup.classify(odd).collect()}
    rows = {(r._at, r._digest): r.text for r in shared.with_key(odd).collect()}
    size = Counter(got[k].class_size for k in rows)
    assert size == {2: 6, 1: 4}
    kept = Counter(rows[k] for k in rows if got[k].kept)
    assert len(kept) == 7 and sum(got[k].kept for k in got if k[0] == shared.NO_ID) == 2
    assert [r.class_id for r in near_dedup.near_classes(odd).where("doc_id IN (2, 3)").collect()] == [1, 1]
    out = P.drop_near_copies(odd.sparkSession, odd, "")
    assert out.columns == odd.columns and out.count() == 7


def test_mixing_repeats_rows_by_id_and_text(spark, odd):
    twice = odd.union(odd.where("doc_id = 8"))
    mixed = P.mix_sources(spark, twice, "")
    assert mixed.columns == odd.columns
    assert Counter(r.text for r in mixed.collect()) == Counter(r.text for r in twice.where("length(text) > 0").collect())


@pytest.mark.parametrize("block", [50_000, 6])
def test_contaminated_rows_go_by_text(spark, odd, block):
    r = random.Random(1)
    item = " ".join(_say(r, 100).split()[20:60])  # in the first text only
    bench = spark.createDataFrame([(1, item), (None, "x y"), (2, None)], "item_id long, text string")
    out = decontaminate.drop_contaminated(odd, bench, block_windows=block)
    gone = [(1,), (2,)]
    assert out.columns == odd.columns and out.count() == odd.count() - len(gone)
    assert sorted(r.doc_id for r in out.where("doc_id < 4").collect()) == [1, 3]


def test_scratch_is_removed(spark, odd):
    base = os.path.dirname(urlparse(shared.shared_dir(spark, "x")).path)
    before = set(glob.glob(f"{base}/*"))
    near_dedup.drop_copies(odd).count()
    assert {x.split("/")[-1].rsplit("-", 1)[0] for x in set(glob.glob(f"{base}/*")) - before} == {"kept"}
