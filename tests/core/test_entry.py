import subprocess
import sys

PROBE = """
import sys
sys.modules["xxhash"] = None  # importing it raises ImportError
import __spark_entry__ as entry
from tidemark import catalog
assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)
"""


def test_core_queries_stay_without_the_libraries_of_the_subpackage():
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=root, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
