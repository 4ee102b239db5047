import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))



@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    # the checkpoint folder comes from the session's configuration when set;
    # tessera.session.checkpoint_dir creates a scratch one only when unset
    s = get_spark("local[4]", 8)
    yield s
    s.stop()
