import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from visitlens.session import build_session

    # The shared folder comes from spark.checkpoint.dir when the environment
    # sets it; visitlens.session.shared_dir makes a private one otherwise.
    session = build_session("local[4]", 4, app_name="visitlens-tests", extra={
        "spark.ui.showConsoleProgress": "false",
    })
    yield session
    session.stop()


def rows(df, *cols):
    """Collected rows as plain tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def explain_text(df, mode="simple"):
    """The physical plan as printed by ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
