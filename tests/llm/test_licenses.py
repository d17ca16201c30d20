import difflib
import random
import textwrap

import pytest

from raregrain.llm import licenses as lc

from .fixtures import awkward_rows, documents, prose

EVERY = [(name, i, wording) for name, ws in lc.TEMPLATES.items() for i, wording in enumerate(ws)]
SCANNER = lc.Scanner(lc.TEMPLATES)


def plain(block):
    """Brute force: the templates whose words stand in the block in one piece, longest first."""
    ws = lc.words(block)
    found = [(len(t), n, i) for n, i, w in EVERY for t in [lc.words(w)]
             if any(ws[k:k + len(t)] == t for k in range(len(ws) - len(t) + 1))]
    return max(found)[1:] if found else None


@pytest.mark.parametrize("name,i,wording", EVERY)
@pytest.mark.parametrize("width", [10_000, 60, 30])
def test_every_wording_is_found_and_named(name, i, wording, width):
    lines = textwrap.wrap(wording, width, break_on_hyphens=False, break_long_words=False)
    text = "\n".join(["Foo bar baz.", "Qux quux.", *lines, "nothing of the kind here"])
    got = SCANNER.scan(text)
    assert [(r[2], r[3]) for r in got if r[2]] == [(name, i)] == [plain(text)]
    assert all(r[5] == r[6] == 0 for r in got if r[2])


def test_a_word_broken_over_two_lines_counts_as_lacking_and_added():
    name, i, wording = next(e for e in EVERY if "licenses/LICENSE-2.0" in e[2])
    broken = wording.replace("licenses/LICENSE-2.0", "licen\nses/LICENSE-2.0")
    whole, cut = (lc.words(t) for t in (wording, broken))
    same = sum(b.size for b in difflib.SequenceMatcher(None, whole, cut, False).get_matching_blocks())
    got = [r for r in SCANNER.scan(f"Foo bar.\n{broken}\nnothing") if r[2]]
    assert [(r[2], r[3], r[5], r[6]) for r in got] == [(name, i, len(whole) - same, len(cut) - same)]
    assert (len(whole) - same, len(cut) - same) != (0, 0)


def test_several_notices_in_a_block():
    text = "Licensed under the Apache License, Version 2.0.\nAll rights reserved.\nReleased under the MIT License."
    assert [(r[0], r[2]) for r in SCANNER.scan(text)] == [(0, "apache-2.0"), (1, "all-rights-reserved"), (2, "mit")]


def test_several_notices_in_a_line():
    text = "Released under the MIT License. Licensed under CC BY-NC 4.0."
    assert [(r[0], r[1], r[2]) for r in SCANNER.scan(text)] == [(0, 1, "cc-by-nc-4.0"), (0, 1, "mit")]
    text = ("so\nfoo All rights reserved. Released under the MIT License. Foo bar; Licensed under\n"
            "CC BY 4.0. Released under the MIT License, see the warranty.")
    assert [(r[0], r[1], r[2]) for r in SCANNER.scan(text)] == [
        (1, 1, "all-rights-reserved"), (1, 1, "mit"), (1, 2, "cc-by-4.0"), (2, 1, None), (2, 1, "mit")]
    twice = SCANNER.scan("Released under the MIT License. Released under the MIT License.")
    assert [(r[0], r[2]) for r in twice] == [(0, "mit")] * 2


def test_every_pair_of_notices_in_a_line_is_found():
    for (a, i, x), (b, j, y) in zip(EVERY, EVERY[7:] + EVERY[:7]):
        got = [(r[2], r[3]) for r in SCANNER.scan(f"{x} {y}") if r[2]]
        assert sorted(got) == sorted([(a, i), (b, j)])


def test_small_edits_are_counted_and_other_versions_are_not_confirmed():
    edited = lc.TEMPLATES["mit"][2].replace("free of charge", "without any charge").upper()
    row = SCANNER.scan(edited)[0]
    assert row[2] == "mit" and 0 < row[5] + row[6] < 10
    other = SCANNER.scan("This work is licensed under the GNU General Public License, version 7.")
    assert [r[2] for r in other] == [None]
    assert [r[2] for r in SCANNER.scan("My driving licence was stolen in spring.")] == [None]


def test_ranking_by_saving_finds_the_wording_that_brute_force_finds():
    rng = random.Random(0)
    for name, i, wording in EVERY:
        block = f"{prose(rng, 5)} {wording} {prose(rng, 5)}"
        top = [SCANNER.templates[k][:2] for _, k in SCANNER.rank(block)[:lc.RANKED]]
        assert plain(block) in top


def test_long_blocks_are_read_whole():
    lines = ["the license of this software and the copyright"] * 400
    lines[333] = "Released under the MIT License."
    assert any(r[0] == 333 and r[2] == "mit" for r in SCANNER.scan("\n".join(lines)))


def test_notice_inside_a_long_line_of_prose_is_found():
    rng = random.Random(3)
    for n in (10, 500, 3000):
        for name, i, wording in EVERY:
            at = rng.randrange(n)
            got = SCANNER.scan(f"{prose(rng, at, 5000)} {wording} {prose(rng, n - at, 5000)}")
            assert [(r[0], r[1], r[2], r[3], r[5], r[6]) for r in got] == [(0, 1, name, i, 0, 0)]
    text = " ".join(f"{prose(rng, rng.randrange(300))} {wording}" for _, _, wording in EVERY)
    assert sorted((r[2], r[3]) for r in SCANNER.scan(text)) == sorted((name, i) for name, i, _ in EVERY)


def test_all_templates_are_compared_where_the_ranking_fails(monkeypatch):
    monkeypatch.setattr(lc.Scanner, "rank", lambda self, block, rank=lc.Scanner.rank: rank(self, block)[::-1])
    for name, i, wording in EVERY:
        assert [(r[2], r[3]) for r in SCANNER.scan(wording)] == [(name, i)]


def test_documents(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80)) for i in range(100, 130)] + awkward_rows()
    planted = {103: ("mit", 0), 110: ("gpl-3.0", 0), 121: ("apache-2.0", 2)}
    rows = [(i, f"{t}\n{lc.TEMPLATES[planted[i][0]][planted[i][1]]}\n{t}" if i in planted else t) for i, t in rows]
    rows += [rows[3]]
    out = lc.scan_licenses(documents(spark, rows, clashes=True)).collect()
    want = [(i, *planted[i], 1) for i in planted] + [(103, *planted[103], 1)]
    assert sorted((r.doc_id, r.license, r.template, r.line) for r in out) == sorted(want)


def test_empty_table_and_own_templates(spark):
    assert lc.scan_licenses(documents(spark, [])).count() == 0
    own = {"house": ["The house licence of the corpus applies."]}
    got = lc.scan_licenses(documents(spark, [(1, "x\nThe house licence of the corpus applies.\ny")]), own).collect()
    assert [(r.doc_id, r.license) for r in got] == [(1, "house")]
    with pytest.raises(ValueError):
        lc.Scanner({"none": ["no such word"]})
