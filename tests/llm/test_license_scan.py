import itertools
import math
import random

from ledgerloom.llm.license_scan import TEMPLATES, aligned, increasing, license_notices, licenses_in, template_of
from llm.texts import long_text

KNOWN = [template_of(name, text) for name, text in TEMPLATES.items()]


def test_longest_increasing_run():
    rng = random.Random(2)
    for _ in range(100):
        values = rng.sample(range(20), rng.randrange(0, 9))
        best = max((len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c)), default=0)
        chain = increasing(values)
        assert len(chain) == best and [values[i] for i in chain] == sorted(values[i] for i in chain) and chain == sorted(chain)


def test_alignment_is_increasing_and_equal():
    rng = random.Random(3)
    for _ in range(200):
        template = [rng.choice("abcdefghij") for _ in range(rng.randrange(0, 15))]
        text = [rng.choice("abcdefghijxyz") for _ in range(rng.randrange(0, 25))]
        pairs = aligned(text, template)
        assert all(text[a] == template[b] for a, b in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(pairs))
    same = "the work is the license of the work".split()
    assert aligned(same, same) == [(at, at) for at in range(len(same))]


def test_repeats_align_in_the_gaps():
    template = "a x b x c x d".split()
    text = "q a x b q x c x d x".split()
    assert [b for _, b in aligned(text, template)] == list(range(7))


def test_every_template_is_found_in_itself_and_in_a_changed_form():
    for name, text in TEMPLATES.items():
        (match,) = licenses_in(f"Some code here. {text.upper()} More of it.", KNOWN)
        assert match.name == name and match.coverage == 1
    words = TEMPLATES["MIT-text"].split()
    words[10:12] = ["a", "new", "part"]
    (match,) = licenses_in(" ".join(words), KNOWN)
    assert match.name == "MIT-text" and 0.9 < match.coverage < 1


def test_edited_notices_at_exactly_the_coverage_are_found():
    """Words that occur once are changed, so more than a fifth of the different words goes with a fifth of all."""
    for name in ("MIT-text", "Apache-2.0-header", "GPL-3.0-header", "BSD-text", "ISC-text"):
        (template,) = (known for known in KNOWN if known.name == name)
        once = [at for at, word in enumerate(template.words) if template.words.count(word) == 1]
        budget = len(template.words) - math.ceil(0.8 * len(template.words))
        rng, reached = random.Random(5), 0
        for _ in range(50):
            words = list(template.words)
            for at in rng.sample(once, budget):
                words[at] = f"changed{at}"
            reaches = len(aligned(words, template.words)) >= 0.8 * len(words)
            found = [match.name for match in licenses_in("some code " + " ".join(words) + " more of it", [template])]
            assert found == [name] * reaches
            reached += reaches
        assert reached


def test_notices_that_differ_in_a_word_or_number_keep_their_names():
    names = ["GPL-2.0-header", "LGPL-2.1-header", "AGPL-3.0-header", "GPL-3.0-header", "MPL-2.0-header", "BSD-text", "BSD-clauses",
             "BSD-3-Clause-text", "CC0-1.0", "Unlicense"]
    filler = "\n" + "other words of a file " * 50 + "\n"
    found = licenses_in(filler.join(TEMPLATES[name] for name in names), KNOWN)
    assert [(match.name, match.coverage) for match in found] == [(name, 1) for name in names]


def test_notices_of_documents(docs):
    mit, apache = TEMPLATES["MIT"], TEMPLATES["Apache-2.0"]
    texts = [None, "", "the license of this work is the work", f"{apache}\n{long_text(20_000)}\n{mit}\n{mit}", mit, "under mit released license the", "é " + mit]
    frame = docs(texts, [0, 1, 2, 3, None, 5, 5])
    rows = sorted((tuple(row) for row in license_notices(frame).collect()), key=str)
    assert [(row[0], row[1]) for row in rows] == [(3, "Apache-2.0"), (3, "MIT"), (3, "MIT"), (5, "MIT"), (None, "MIT")]
    for doc_id, name, coverage, start, end in rows:
        text = {3: texts[3], 5: texts[6], None: mit}[doc_id]
        assert coverage == 1 and text[start:end] + "." == TEMPLATES[name]
    assert license_notices(docs([])).count() == 0


def test_planted_license_lines(documents):
    found = {row["doc_id"] for row in license_notices(documents).collect()}
    lines = [TEMPLATES[name] for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0")]
    assert found == {row["doc_id"] for row in documents.collect() if any(line in row["text"] for line in lines)}
