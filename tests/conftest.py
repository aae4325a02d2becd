import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from closepass.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        "4g",
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Approaches on the thresholds of the categories: just below the first ones, then on each."""
    rows = [
        ("below18", "Below Eighteen", 17.99, 0.0499, 30.1, "2003-02-28", 2003),
        ("on18", "On Eighteen", 18.0, 0.0999, 20.0, "2003-03-01", 2003),
        ("on20", "On Twenty", 20.0, 0.1, 19.99, "2004-02-29", 2004),
        ("on22", "On Twenty-Two", 22.0, 0.2, 30.0, "2011-12-31", 2011),
        ("on25", "On Twenty-Five", 25.0, 0.0001, 9.5, "2012-01-01", 2012),
    ]
    schema = (
        "des string, fullname string, h double, dist double, v_rel double, cd string,"
        " approach_year long"
    )
    return spark.createDataFrame(rows, schema).selectExpr(
        "des", "fullname", "h", "dist", "v_rel", "CAST(cd AS timestamp_ntz) AS cd", "approach_year"
    )


@pytest.fixture(scope="session")
def approaches(spark):
    from closepass.plans import inputs

    return inputs.named_approaches(spark, SF_DIR).cache()
