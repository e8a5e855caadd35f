from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from basketry.session import build_session

    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "8", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__checkpoint__dir=str(home / "shared"), spark__sql__warehouse__dir=str(home / "warehouse"),
    )
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples; None sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
