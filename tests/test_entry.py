import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region_code", "region_prospects", "total_annual_premium",
                          "total_claims_amount", "total_claims_count"]
    assert df.count() == 25


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_works_without_the_optional_operators():
    """The remaining queries stand alone when the optional folder is absent."""
    import subprocess
    import sys
    import os
    code = ("import sys, importlib.abc\n"
            "class Absent(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'propensity.llm'):\n"
            "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
            "sys.meta_path.insert(0, Absent())\n"
            "import __spark_entry__ as e\n"
            "assert 'prepared' in e.queries() and 'pipeline' not in e.queries()\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
