import datetime
import random
import re

import pytest

from marketgrain.llm import op6_pseudonyms as pii

KEY = b"a key"


@pytest.mark.parametrize("size", [2, 3, 10, 90, 1000, 1023])
def test_every_value_moves_to_another(size):
    found = [pii.moved(x, size, KEY, "t") for x in range(size)]
    assert sorted(found) == list(range(size))
    assert all(a != b for a, b in enumerate(found))
    assert [pii.moved(y, size, KEY, "t", -1) for y in found] == list(range(size))


def test_values_keep_their_format():
    cases = {
        "4845168114407329": "card", "4845-1681-1440-7329": "card", "und.34@mail7.example.com": "email", "A.b9@X.org": "email",
        "+1 (017) 555-7713": "phone", "(017) 555-7713": "phone", "+49 30 1234567": "phone", "144.137.247.239": "ip", "8.20.209.178": "ip",
        "DE89 3704 0044 0532 0130 00": "iban", "2020-02-29": "date", "31.12.1999": "date", "3/4/2020": "date", "123-45-6789": "ssn",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"': "secret",
    }
    shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "9", s)))
    for text, kind in cases.items():
        new, spans = pii.replaced(f"see {text}, please", KEY)
        assert [s[0] for s in spans] == [kind], text
        assert text not in new
        if kind not in ("secret", "iban") and text != "3/4/2020":
            assert shape(new) == shape(f"see {text}, please")
        start, length = spans[0][1:]
        again = pii.replaced(new, KEY)[1]  # still valid in its format
        assert [s[:2] for s in again] == [s[:2] for s in spans]
        assert new[:start] == f"see {text}"[:start] and new.endswith(", please") and start + length <= len(new)
        assert pii.replaced(new, KEY, -1)[0] == f"see {text}, please"


def test_what_fails_its_check_stays():
    text = "9807915762804491 300.1.1.1 2021-02-30 31.31.2020 DE89 3704 0044 0532 0130 01 000-12-3456 version 2.0.1 4.0. 666-10-1000"
    assert pii.replaced(text, KEY) == (text, [])


def test_neighbours_do_not_hide_a_value():
    cases = [
        ("AT61 1904 3002 3457 3201", " BIC"), ("AT611904300234573201", " EUR"), ("ES91 2100 0418 4502 0005 1332", " 2024"),
        ("DE89 3704 0044 0532 0130 00", " 1234 5678"), ("31/01/2024", " x"), ("31/1/2024", ", 5"),
    ]
    for value, rest in cases:
        new, spans = pii.replaced(f"see {value}{rest}", KEY)
        assert len(spans) == 1 and value not in new and new.endswith(rest), value
        assert spans[0][0] == ("date" if "/" in value else "iban")
        assert pii.replaced(new, KEY, -1)[0] == f"see {value}{rest}"
    new, spans = pii.replaced("ES91 2100 0418 4502 0005 1332 2024-01-31", KEY)
    assert [s[0] for s in spans] == ["iban", "date"]
    for text in ("31/02/2024", "31/13/2024", "13/1/1850"):
        assert pii.replaced(text, KEY) == (text, [])


def test_equal_values_stay_linked_and_keys_matter():
    a, b = pii.replaced("4845168114407329 x", KEY)[0], pii.replaced("y 4845 1681 1440 7329", KEY)[0]
    assert a.split()[0] == "".join(b.split()[1:])
    assert pii.replaced("4845168114407329", b"other")[0] != a.split()[0]
    new, spans = pii.replaced("+1 (017) 555-7713 144.137.247.239 4845168114407329 4845168114407329", KEY)
    assert [s[0] for s in spans] == ["phone", "ip", "card", "card"]
    assert new.split()[-1] == new.split()[-2]


def test_stretches_hold_all_there_is():
    rng = random.Random(1)
    parts = ["plain words " * rng.randint(0, 80) + v for v in ("und.34@mail7.example.com ", "8.20.209.178 ", "\n+1 (017) 555-7713 ", "2020-02-29 ", "1 ") * 6]
    text = "".join(parts)
    whole = [m.span() for m in pii.PATTERN.finditer(text)]
    assert [m.span() for low, high in pii.regions(text) for m in pii.PATTERN.finditer(text, low, high)] == whole


def test_rows(docs, odd):
    texts = ["mail a.b1@x.org now", None, "", "none", "mail a.b1@x.org now", "x" * 200_000 + " 4845168114407329"]
    found = {r["doc_id"]: r for r in pii.pseudonymised(docs(texts), KEY).collect()}
    assert found[0]["text"] == found[4]["text"] != texts[0]
    assert found[1]["text"] is None and found[2]["text"] == "" and found[3]["text"] == "none"
    assert [found[i]["n_found"] for i in range(6)] == [1, 0, 0, 0, 1, 1]
    assert found[5]["found"][0].asDict() == {"kind": "card", "start": 200_001, "length": 16}
    assert pii.pseudonymised(odd).count() == odd.count()
    assert pii.pseudonymised(docs([])).collect() == []


def test_days_cover_two_centuries():
    assert pii.date("1899-12-31", KEY, 1, "ymd", "-") is None
    assert datetime.date.fromisoformat(pii.date("2099-12-31", KEY, 1, "ymd", "-"))
