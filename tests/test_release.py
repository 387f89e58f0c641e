"""Intermediates go when the application releases them, and nothing else does."""

import os
from urllib.parse import urlparse

from starloom.session import checkpoint_dir, materialize, release


def test_release_removes_only_its_own_folder(spark):
    base = urlparse(checkpoint_dir(spark)).path
    other = os.path.join(base, "other")
    os.makedirs(other, exist_ok=True)
    assert materialize(spark.range(3), "released").count() == 3
    assert os.listdir(os.path.join(base, "starloom"))
    release(spark)
    assert not os.path.exists(os.path.join(base, "starloom")) and os.path.exists(other)
    assert materialize(spark.range(3), "again").count() == 3
