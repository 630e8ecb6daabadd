import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from spendlens.session import build_session  # noqa: E402
from spendlens.sources.tables import Warehouse  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "spendlens-tests",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples of the named columns."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def lines(spark):
    """JSON texts as archive lines."""

    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "line string")

    return make


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


# ------------------------------------------------------------------ a small hand-made domain

DAY = "2026-08-01"


def activity(day, login, ides, features=(), org="acme"):
    """Staging rows of one user's day: (ide, interactions, generations), (model, feature, interactions)."""
    return {
        "user_day": [(day, login, 1, org)],
        "user_ide": [(day, login, org, ide, ide.upper(), i, g) for ide, i, g in ides],
        "user_model_feature": [(day, login, org, m, f, i) for m, f, i in features],
    }


SHAPES = {
    "user_day": "activity_date string, user_login string, user_id bigint, org_login string",
    "user_ide": "activity_date string, user_login string, org_login string, ide string, ide_family string, "
    "user_initiated_interaction_count int, code_generation_activity_count int",
    "user_model_feature": "activity_date string, user_login string, org_login string, model_name string, "
    "feature string, user_initiated_interaction_count int",
    "user_teams": "activity_date string, user_login string, user_id bigint, org_login string, team_id bigint, "
    "team_slug string",
    "premium_requests": "usage_date string, user_login string, org_login string, product string, sku string, "
    "model_name string, net_amount string",
    "seats": "user_login string, user_id bigint, org_login string, team_name string, plan_type string, "
    "last_activity_at string",
}


@pytest.fixture(scope="session")
def frames(spark):
    """Datasets from {name: rows}; absent ones are empty."""

    def make(data):
        return {n: spark.createDataFrame(data.get(n, []), s) for n, s in SHAPES.items()}

    return make


@pytest.fixture(scope="session")
def golden():
    """One user-day for every tier of the allocation, ten dollars each."""
    data = {n: [] for n in SHAPES}
    users = {
        "prompts": activity(DAY, "prompts", [("zed", 13, 5), ("emacs", 7, 4)],
                            [("opal-2", "agent_edit", 6), ("opal-2", "chat_inline", 2)]),
        "codes": activity(DAY, "codes", [("vscode", 0, 1), ("vim", 0, 3)], [("opal-2", "chat_inline", 0)]),
        "equal": activity(DAY, "equal", [("vscode", 0, 0), ("vim", 0, 0), ("emacs", 0, 0)]),
        "idle": activity(DAY, "idle", [], [("opal-2", "chat_inline", 0), ("opal-2", "agent_edit", 0)]),
        "none": activity(DAY, "none", []),
        "zero": activity(DAY, "zero", [("vscode", 4, 0), ("vim", 0, 9)]),
    }
    for i, (login, parts) in enumerate(users.items(), start=1):
        for name, found in parts.items():
            data[name] += found
        data["premium_requests"].append((DAY, login, "acme", "plan", "premium", "opal-2", "10.0000"))
        data["seats"].append((login, i, "acme", "Platform" if i % 2 else "", "business", "2026-08-01 10:00:00"))
        data["user_teams"].append((DAY, login, i, "acme", 42, "frontend"))
    data["user_teams"].append((DAY, "prompts", 1, "acme", 43, "backend"))
    return data
