import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session("*", 8, app="tidemark-tests")
    yield s


@pytest.fixture(scope="session")
def cleaned_small(spark):
    from tidemark.plans import catalog

    return catalog.cleaned(spark, SF_SMALL)


def tx_frame(spark, rows, extra_schema=""):
    """A hand-made transaction table (FIXTURES §1 schema) with batch ids."""
    schema = (
        "Transaction_ID long, Transaction_Date timestamp_ntz, Transaction_Amount double, Account_Balance double, "
        "Age int, Transaction_Type string, Device_Type string, State string, Is_Fraud int, row_idx long, batch_index int"
        + extra_schema
    )
    return spark.createDataFrame(rows, schema)
