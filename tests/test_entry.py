import importlib.util
import os

from conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "segmento" in df.columns
    assert set(m.oracle_sql()) <= set(m.queries())


def test_contract_imports_without_spark():
    """The driver may ask for oracle_sql() before any session exists."""
    import subprocess
    import sys
    code = ("import importlib.util as u; s=u.spec_from_file_location('e','__spark_entry__.py'); "
            "m=u.module_from_spec(s); s.loader.exec_module(m); "
            "from starloom.plans import catalog as c; q=set(m.queries()); o=set(m.oracle_sql()); "
            "assert o <= q and set(c.queries()) == set(c.oracle_sql()) <= o and len(o) > 50, (len(q), len(o))")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_python_tasks_work_from_another_cwd(tmp_dir):
    """Workers import the package even when the driver runs elsewhere (shipped with addPyFile)."""
    import subprocess
    import sys
    code = f"""
import importlib.util as u
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()
s = u.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r}); m = u.module_from_spec(s)
s.loader.exec_module(m)
n = m.queries()['s08_workbook'](spark, '/root/testdata/sf0.001').count()
assert n > 0, n
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, check=True, timeout=300,
                   env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_results_do_not_depend_on_session_time_zone(tmp_dir):
    """Parsing and formatting happen in one session zone, so a DST zone gives the oracle's results."""
    import subprocess
    import sys
    code = f"""
import sys
sys.path.insert(0, {ROOT!r}); sys.path.insert(0, {os.path.join(ROOT, 'tests')!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')
         .config('spark.sql.session.timeZone', 'America/New_York').getOrCreate())
from starloom.plans.catalog import queries, oracle_sql
from oracle_harness import compare
for n in ['d01_parse_timestamp', 'gold_fact_entregas']:
    r = compare(spark, '/root/testdata/sf0.001', n, queries()[n], oracle_sql()[n])
    assert r['status'] == 'match', r
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, check=True, timeout=300)
