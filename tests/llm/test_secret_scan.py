"""op3: random strings beside known or ordinary parts of the same run."""
import random
import string

import pytest

from ridegrid.llm import secret_scan as S

UUID = "123e4567-e89b-12d3-a456-426614174000"
PATH = "/webhooks/callback/production/notifications/"
BEFORE = {"bare": "", "path": PATH, "uuid": f"/cb/{UUID}/", "hex": "0a" * 20 + "/", "access": "AKIA" + "A1" * 8 + "=/"}


def scan(text):
    encode = S.vocabulary(S.VOCABULARY).encode_ordinary
    return S.random_spans(text, S.base_spans(text), encode, 2.1)


@pytest.mark.parametrize("before", BEFORE)
@pytest.mark.parametrize("n", [20, 24, 32, 40])
def test_random_part_is_reported(before, n):
    rng = random.Random(n)
    missed = 0
    for _ in range(100):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=n))
        at = len(BEFORE[before]) + 4
        missed += scan(f"see {BEFORE[before]}{secret} now") != [(at, 3, at + n)]
    assert missed <= 2


@pytest.mark.parametrize("before", ["bare", "path", "uuid", "hex"])
def test_base64_parts_are_joined(before):
    rng = random.Random(8)
    for _ in range(100):
        secret = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=44))
        at = len(BEFORE[before])
        found = scan(BEFORE[before] + secret)
        assert found and max(e for _, _, e in found) > at + 20 and min(s for s, _, _ in found) >= at - 1


@pytest.mark.parametrize("text", [
    PATH, f"/cb/{UUID}/status", "0123456789ABCDEF" * 4 + "/download", "2024-01-31/123456789012345678",
    "getElementByIdAndUpdateAll/internationalCorrespondence_settings", "a" * 10 + "-" + "b" * 10 + "_words"])
def test_ordinary_parts_are_not(text):
    assert scan(text) == []


def test_gaps():
    assert S.gaps(5, 20, [(0, 7), (9, 12), (10, 11), (18, 30)]) == [(7, 9), (12, 18)]
    assert S.gaps(5, 8, []) == [(5, 8)] and S.gaps(5, 8, [(1, 9)]) == []
