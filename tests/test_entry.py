"""The entry module without the optional package, and a session started elsewhere."""

import os
import shutil
import subprocess
import sys
import textwrap
import zipfile

from settlebook.shipping import package_zip

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str, folder: str, timeout: int = 300) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=folder, env=env, capture_output=True, text=True, timeout=timeout)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_core_loads_without_what_the_optional_package_needs(tmp_path):
    out = run(f"""
        import sys
        sys.modules["public_tokenizers"] = None
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as e
        print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), any(q.startswith("op") and q[2].isdigit() for q in e.queries()))
    """, str(tmp_path))
    n, rest = out.split(" ", 1)
    assert int(n) >= 53 and rest.strip() == "[] False"


def test_core_loads_without_the_optional_package(tmp_path):
    shutil.copytree(os.path.join(ROOT, "settlebook"), tmp_path / "settlebook", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    out = run("""
        import __spark_entry__ as e
        from settlebook import close, shipping
        print(set(e.queries()) == set(e.oracle_sql()), len(e.queries()))
    """, str(tmp_path))
    assert out.startswith("True") and int(out.split()[1]) >= 53


def test_the_shipped_package_is_whole(tmp_path):
    names = zipfile.ZipFile(package_zip(str(tmp_path))).namelist()
    assert "settlebook/__init__.py" in names and "settlebook/plans/closing.py" in names and not any("__pycache__" in n for n in names)


def test_workers_of_a_session_started_elsewhere_import_the_package(tmp_path):
    """The driver finds the package by a path of its own; workers only by what is shipped."""
    out = run(f"""
        import os, sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        sys.path.insert(0, {ROOT!r})
        from settlebook.shipping import ship
        ship(spark); ship(spark)

        def where(batches):
            import pyarrow as pa
            import settlebook.functions.timez as m
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([m.__file__] * b.num_rows)], ["f"])

        print("file", spark.range(2).mapInArrow(where, "f string").first()[0])
    """, str(tmp_path))
    assert "settlebook.zip" in out.split("file ")[1]
