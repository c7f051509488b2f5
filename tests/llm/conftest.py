import pytest
from pyspark import cloudpickle

import parlato

# so that workers see values that a test changes
cloudpickle.register_pickle_by_value(parlato)


@pytest.fixture
def documents(spark):
    """Rows ``doc_id, text, lang, source`` with an extra column of a clashing name."""

    def make(rows, **more):
        schema = "doc_id long, text string, lang string, source string, score string"
        return spark.createDataFrame([(i, t, *rest, *[None] * (3 - len(rest))) for i, t, *rest in rows], schema)

    return make
