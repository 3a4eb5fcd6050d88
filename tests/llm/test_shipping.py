"""Queries started outside the repository, and folders that operators leave."""

import os
import subprocess
import sys

import public_tokenizers

import corpus_pipeline
from logtally.llm.bpe import encode_word, read_ranks
from logtally.llm.common import materialise, scratch
from logtally.llm.queries import QUERIES
from logtally.session import ensure_checkpoint_dir
from tests.llm.helpers import documents, frame

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_by_path", sys.argv[1] + "/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
for name in sys.argv[2].split(","):
    spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    print("ROWS", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
    spark.stop()
"""


def test_each_query_runs_first_in_a_session_started_elsewhere(tmp_path):
    names = [*QUERIES, "pipeline"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", _SCRIPT, ROOT, ",".join(names)], cwd=tmp_path, env=env, capture_output=True, text=True,
                          timeout=1200)
    found = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS"))
    assert list(found) == names and all(int(n) > 0 for n in found.values()), done.stderr[-2000:]


def _folders(spark):
    path = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sorted(os.listdir(path))


def test_scratch_drops_what_operators_wrote(spark, tmp_path):
    frame(spark, documents(5, 40)).write.parquet(f"{tmp_path}/documents.parquet")
    before = _folders(spark)
    for name in ("op1_substring_dedup", "op3_simhash", "op9_exact_dedup", "op11_token_alignment", "op12_suffix_ranks"):
        with scratch(spark):
            QUERIES[name](spark, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        assert _folders(spark) == before, name
    with scratch(spark):
        corpus_pipeline.run(spark, str(tmp_path)).write.parquet(f"{tmp_path}/pipeline")
    assert _folders(spark) == before
    assert spark.read.parquet(f"{tmp_path}/pipeline").count() > 0
    with scratch(spark):
        outer = materialise(frame(spark, documents(5, 6)), "outer")
        with scratch(spark):
            materialise(outer, "inner")
        assert outer.count() == 13              # an inner block leaves the outer one's folders
    assert [x for x in _folders(spark) if x.startswith(("outer", "inner"))] == []


def test_a_word_of_any_length_is_redone_in_seconds():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))

    def plain(word):
        if word in ranks:
            return [ranks[word]]
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    for word in ("hello", "aaaaaaaaaaaaaaaaa", "Überraschungsmoment" * 3, "日本語テキスト" * 9, "xqzzyabcabc" * 20, "ab" * 77 + "c"):
        assert encode_word(word.encode(), ranks) == plain(word.encode())
    assert sum(1 for _ in encode_word(b"abcdefghij" * 10_000, ranks)) > 1000
