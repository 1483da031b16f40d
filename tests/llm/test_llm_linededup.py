import random
import re

import pytest

from strataline.llm.linededup import line_report, remove_repeated_lines, repeated_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def content(text):
    return [x for x in (text or "").split("\n") if WORD.search(x)]


def brute(texts, least):
    """Lines in a run of ``least`` words that occurs earlier, but not within its first place."""
    lines = [content(t) for t in texts]
    first, places = {}, []
    for d, own in enumerate(lines):
        for i in range(len(own)):
            for j in range(i, len(own)):
                run = tuple(own[i : j + 1])
                if sum(len(WORD.findall(x)) for x in run) < least:
                    continue
                first.setdefault(run, (d, i))
                places.append((run, d, i, j))
    gone = [set() for _ in texts]
    # Only the shortest runs from and to a line decide; longer ones are their unions.
    for run, d, i, j in places:
        n = [len(WORD.findall(x)) for x in run]
        if sum(n[:-1]) >= least and sum(n[1:]) >= least:
            continue
        f, at = first[run]
        if (f, at) != (d, i):
            gone[d] |= set(range(max(i, at + len(run)) if f == d else i, j + 1))
    return [(len(own), sorted(g)) for own, g in zip(lines, gone, strict=True)]


@pytest.mark.parametrize("least", [1, 3, 7, 12])
def test_report_agrees_with_brute_force(docs, least):
    rng = random.Random(least)
    pool = [" ".join("ab"[rng.randrange(2)] for _ in range(rng.randrange(1, 5))) for _ in range(7)] + ["", " \t"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(25)]
    texts += [texts[3] + "\nx " + str(least), "\n".join(["same line"] * 30), None, ""]
    got = [(r.n_lines, list(r.deleted)) for r in line_report(docs(texts), min_words=least).orderBy("doc_id").collect()]
    assert got == brute(texts, least)


@pytest.mark.parametrize("least", [1, 3, 7])
def test_runs_are_the_same_lines_and_maximal(docs, least):
    rng = random.Random(100 + least)
    pool = [" ".join("abc"[rng.randrange(3)] for _ in range(rng.randrange(1, 5))) for _ in range(6)]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(14))) for _ in range(20)] + [None, "\n".join(["x y"] * 12)]
    lines = [content(t) for t in texts]
    deleted = {r.doc_id: set(r.deleted) for r in line_report(docs(texts), min_words=least).collect()}
    found, covered = repeated_runs(docs(texts), min_words=least).collect(), {}
    assert found
    for r in found:
        own, first = lines[r.doc_id], lines[r.first_doc_id]
        assert (r.first_doc_id, r.first_start) < (r.doc_id, r.start)
        run = own[r.start : r.start + r.lines]
        assert run == first[r.first_start : r.first_start + r.lines] and len(run) == r.lines
        assert sum(len(x.split()) for x in run) >= least
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.lines))
    assert all(deleted[d] <= covered.get(d, set()) for d in deleted)
    for a in found:
        for b in found:
            same = (a.doc_id, a.first_doc_id, a.start - a.first_start) == (b.doc_id, b.first_doc_id, b.start - b.first_start)
            assert a == b or not same or b.start > a.start + a.lines or a.start > b.start + b.lines


def test_a_long_passage_is_one_run(docs):
    passage = "\n".join(f"line {k} with these seven words here" for k in range(40))
    (run,) = repeated_runs(docs([f"a\n{passage}", f"x\ny\n{passage}\nz"])).collect()
    assert (run.doc_id, run.start, run.lines, run.first_doc_id, run.first_start) == (1, 2, 40, 0, 1)


def test_text_without_the_repeated_run(docs):
    passage = "\n".join(f"line {k} with these seven words here" for k in range(9))
    frame = docs([f"first\n{passage}\nend", f"a\n\n{passage}\n \nb", passage, "short\nline"])
    kept = {r.doc_id: (r.text, r.n_chars) for r in remove_repeated_lines(frame).collect()}
    assert kept == {
        0: (f"first\n{passage}\nend", len(passage) + 10),
        1: ("a\n\n \nb", 6),
        3: ("short\nline", 10),
    }


def test_awkward_documents(awkward, nothing):
    kept = remove_repeated_lines(awkward)
    assert kept.schema == awkward.schema
    # Of the prose the row with the id stays, once; the long text is whole.
    rows = kept.collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in rows if r.text and r.text.strip() and r.doc_id != 4) == [
        (5, "other"), (5, "p0 p1"), (6, "é ünï"),
    ]
    assert [r.text for r in rows if r.doc_id == 4] == [awkward.where("doc_id = 4").first().text]
    assert sum(1 for r in rows if r.text is None) == 2
    report = line_report(awkward).collect()
    assert len(report) == awkward.count()
    assert sorted(len(r.deleted) for r in report) == [0] * 8 + [1, 1]
    assert line_report(nothing).collect() == [] and remove_repeated_lines(nothing).collect() == []
