import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from headstart.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def emb(spark):
    from headstart.sources.features import read_features

    return read_features(spark, f"{SF01}/embeddings.parquet", features="embedding", columns=["vec_id"])
