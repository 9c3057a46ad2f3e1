import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pktsieve.session import local_session

    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def dt(spark):
    from pktsieve.plans.models import shipped_dt

    return shipped_dt(spark)


@pytest.fixture(scope="session")
def km(spark):
    from pktsieve.plans.models import shipped_km

    return shipped_km(spark)


def compile_text(spark, text, model_id="m"):
    from pktsieve.operators.dtree_compile import compile_from_lines
    from pktsieve.sources.models import model_lines_from_text

    df = spark.createDataFrame([(model_id, text)], "model_id string, text string")
    return compile_from_lines(spark, model_lines_from_text(df))


def shuffles_over(df, table: str) -> int:
    """Number of shuffle exchanges whose subtree reads ``table`` (plan text)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    n = 0
    for i, line in enumerate(lines):
        if "Exchange" in line and "BroadcastExchange" not in line:
            d = depth(line)
            for sub in lines[i + 1:]:
                if depth(sub) <= d:
                    break
                if table in sub:
                    n += 1
                    break
    return n
