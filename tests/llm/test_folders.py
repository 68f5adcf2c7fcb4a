"""The shared folder: what operators leave in it, and who takes it away."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from relweave.llm import common, embeddings, minhash, pipeline
from relweave.llm.common import cleared, marked


def _left(spark) -> list[str]:
    at = Path(common._work[id(spark.sparkContext)].removeprefix("file://"))
    return sorted(p.name for p in at.iterdir())


def test_a_cluster_needs_a_shared_folder():
    for master, fine in (("local", True), ("local[4]", True), ("local-cluster[2,1,1024]", False), ("spark://host:7077", False), ("yarn", False)):
        spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master=master))
        if fine:
            assert common.shared_dir(spark).startswith("file:///")
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                common.shared_dir(spark)


def test_nothing_is_left(spark):
    """Rounds and candidates go by themselves; what a lazy result needs goes when it has been written elsewhere."""
    docs = spark.createDataFrame([(i, f"some words that are the same but for {i // 2} at the end") for i in range(40)], "doc_id bigint, text string")
    vectors = spark.createDataFrame([(i, [1.0, i // 4 * 0.5], 1) for i in range(40)], "vec_id bigint, embedding array<double>, label int")
    common.fresh_path(spark, "first")
    before, mark = _left(spark), marked(spark)
    out = [minhash.near_duplicates(docs).collect(), embeddings.near_duplicates(vectors).collect()]
    assert len(out[0]) == len(out[1]) == 40 and len(_left(spark)) > len(before)
    cleared(spark, mark)
    assert _left(spark) == before and marked(spark) == mark


def test_pipeline_takes_its_stages_away(spark, tmp_path):
    spark.createDataFrame([(i, f"words of the text number {i} and more of them", "en", "s", 1) for i in range(30)], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    common.fresh_path(spark, "first")
    before, mark = set(_left(spark)), marked(spark)
    assert pipeline.run(spark, str(tmp_path)).count() > 0
    # The last stage's documents, its files and what was read from them.
    assert {x.split("-")[0] for x in set(_left(spark)) - before} == {"mix_sources", "tokens", "read"}
    cleared(spark, mark)
    assert set(_left(spark)) == before


def test_the_session_takes_its_folder_away(tmp_path):
    code = "from pyspark.sql import SparkSession\nfrom relweave.llm.common import stored\ns = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', 'file://%s').getOrCreate()\nassert stored(s.range(5), 'x').count() == 5\nimport os; print(os.listdir('%s/relweave'))\n" % (tmp_path, tmp_path)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=Path(__file__).parents[2], env=os.environ | {"PYTHONPATH": str(Path(__file__).parents[2])})
    assert out.returncode == 0 and len(eval(out.stdout.splitlines()[-1])) == 1, out.stderr[-500:]
    assert os.listdir(tmp_path / "relweave") == []
