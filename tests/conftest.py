import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    from millrace.sinks.files import drop_scratch

    drop_scratch(session)
    session.stop()


@pytest.fixture()
def rows():
    """Rows of a DataFrame as a sorted list of plain tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect


@pytest.fixture()
def plan():
    """The formatted physical plan of a DataFrame as text."""

    def text(df):
        return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    return text
