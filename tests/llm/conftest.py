import hashlib
import random

import pytest


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture
def sha():
    return lambda data: hashlib.sha256(data).hexdigest()
