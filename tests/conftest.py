import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from terrace.session import checkpoint_dir, local_session
    s = local_session(cores=4, shuffle_partitions=4)
    checkpoint_dir(s)  # tests: a scratch folder only when the session names none
    yield s


SF = "/root/testdata/sf0.001"
