"""License scans: inserted words and dense repeats."""

import time

import pytest

from vitalgrid.llm.license_texts import TEMPLATES
from vitalgrid.llm.licenses import Scanner

SCANNER = Scanner(TEMPLATES)
LONG = [(name, max(TEMPLATES[name], key=len)) for name in ("MIT", "ISC", "BSD", "GPL-3.0", "Apache-2.0")]


@pytest.mark.parametrize("count", [17, 50, 200])
@pytest.mark.parametrize("name, text", LONG)
def test_inserted_words_do_not_hide_a_text(name, text, count):
    words = text.split()
    foreign = " ".join(("page", "the", "of", f"x{i}")[i % 4] for i in range(count))
    for share in (0.3, 0.5, 0.7):
        at = int(len(words) * share)
        whole = f"{' '.join(words[:at])} {foreign} {' '.join(words[at:])}"
        coverage, spans = SCANNER.scan(f"code {whole} code")[name]
        assert coverage >= 0.95 and spans[0][0] == 5 and len(spans) <= 2
        assert len(whole) - 2 <= spans[-1][1] - 5 <= len(whole)


def test_words_inserted_twice():
    words = dict(LONG)["MIT"].split()
    foreign = " ".join(f"x{i}" for i in range(40))
    text = f" {foreign} ".join(" ".join(words[b:b + 55]) for b in range(0, 165, 55))
    coverage, spans = SCANNER.scan(text)["MIT"]
    assert coverage == 1.0 and len(spans) == 3


def test_halves_in_the_wrong_order_are_no_license():
    words = dict(LONG)["MIT"].split()
    half, foreign = len(words) // 2, " ".join(f"x{i}" for i in range(50))
    assert "MIT" not in SCANNER.scan(" ".join(words[half:] + [foreign] + words[:half]))


@pytest.mark.parametrize("gap", [0, 1, 5, 15, 30])
@pytest.mark.parametrize("name, notice", [("MIT", "Released under the MIT License."), ("CC-BY-4.0", "Licensed under CC BY 4.0.")])
def test_dense_notices_have_a_span_each(name, notice, gap):
    line = notice + "".join(f" pkg{i}" for i in range(gap)) + "\n"
    coverage, spans = SCANNER.scan(line * 40)[name]
    assert coverage == 1.0 and len(spans) == 40
    assert all((line * 40)[b:e] == notice.rstrip(".") for b, e in spans)


def test_long_runs_of_notices_take_time_in_proportion():
    begin = time.monotonic()
    assert len(SCANNER.scan("Released under the MIT License. pkg\n" * 5_000)["MIT"][1]) == 5_000
    assert time.monotonic() - begin < 60
