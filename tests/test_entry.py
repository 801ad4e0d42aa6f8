import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry
from docloom.session import local_session
spark = local_session("elsewhere", 2)
print(entry.queries()["id_slices"](spark, {{0!r}}).count(), entry.queries()["knn_exact"](spark, {{0!r}}).count())
sys.path.pop(0)
"""


def test_tasks_run_where_the_package_is_not_installed(tmp_path, small):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(small)], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["1", "160"]


def test_register_covers_the_survey():
    import __spark_entry__ as entry

    names = {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}
    known = set(entry.oracle_sql()) & names
    assert len(names) == 77 and len(names - known) == 1
