import uuid

import pytest


@pytest.fixture(autouse=True)
def own_workers(request):
    """Tests about what a worker keeps run on Python workers of their own: of several idle ones any may take a task."""
    if "workers_of_a_session" in request.node.name:
        request.getfixturevalue("spark").sparkContext.environment["SCRIPTORIUM_TESTS"] = uuid.uuid4().hex
    yield
