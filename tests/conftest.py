import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silverline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("silverline-tests", cores="*", shuffle_partitions=8,
                      checkpoint_dir=str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
