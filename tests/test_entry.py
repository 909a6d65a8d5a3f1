"""The driver contract in a process that has imported nothing else."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import __spark_entry__ as entry
from kerbside.session import build_session
spark = build_session("fresh", "local[2]", spark__sql__shuffle__partitions="4")
spark.sparkContext.setLogLevel("ERROR")
assert entry.entry(spark).limit(1).count() == 1
queries = entry.queries()
df = queries["en_summary"](spark, entry.SMOKE_FOLDER)
assert df.limit(1).count() == 1 and set(entry.oracle_sql()) <= set(queries)
print("well", len(queries))
"""


def test_entry_in_a_fresh_process():
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert "well" in done.stdout, done.stderr[-2000:]
