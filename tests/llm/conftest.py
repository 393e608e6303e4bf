import pytest

from touchledger.llm.common import prepared
from touchledger.plans.workspace import Workspace


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the settings of the operators; its package shipped to the workers."""
    return prepared(spark)


@pytest.fixture
def workspace(llm, tmp_path):
    return Workspace(llm, str(tmp_path))


@pytest.fixture
def documents(llm):
    def make(*rows, schema="doc_id bigint, text string"):
        return llm.createDataFrame([tuple(r) for r in rows], schema)
    return make
