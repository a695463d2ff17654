"""The shared work folder."""

import os
from unittest.mock import Mock

import pytest

from threadline import work


def test_tables_are_kept_and_cleared(spark):
    table = work.kept(spark.range(5))
    at = work.folder(spark).removeprefix("file://")
    assert table.count() == 5 and os.path.isdir(at)
    work.clear(spark)
    assert not os.path.exists(at)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1000]"])
def test_a_cluster_needs_a_shared_folder(master):
    session = Mock()
    session.sparkContext.master = master
    session.sparkContext.getConf().get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        work.folder(session)
