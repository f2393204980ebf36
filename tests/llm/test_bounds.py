"""Long inputs, memory of one task, and the parts of tokenizing and HTML that have their own rules."""

import json
import random
import time
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from tabquorum.llm import html, near, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def spec():
    with open(PATH, encoding="utf-8") as file:
        return json.load(file)


# tokens ----------------------------------------------------------------------------------------

def test_only_files_that_fit_are_encoded_by_words(tmp_path):
    assert tokens.word_by_word(spec()) and type(tokens._encoder(PATH)) is tokens.WordEncoder
    for change in ({"truncation": {"max_length": 3}}, {"post_processor": {"type": "x"}}, {"normalizer": {"type": "Sequence", "normalizers": []}},
                   {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [{"content": "the end", "lstrip": False}]}, {"added_tokens": [{"content": "<a.b>"}]}):
        assert not tokens.word_by_word(spec() | change)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        assert not tokens.word_by_word(json.load(file))
    other = tokens._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert type(other) is tokens.Encoder
    texts = ["Hello  world.", None, "a\tb", ""]
    ids, counts = other.texts(pa.array(texts, pa.string()))
    want = [other.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


AWKWARD = ["it's.", "U.S.A.", "don't,", "a..", "a,.", ".", ",", "x.y", "É.", "é,", "É.", "H̱", "ẖ.", "<|endoftext|>", "<|ENDOFTEXT|>.", "a<b.",
           "İ", "ß.", " x.", "tab\tin.", "\x0b", "漢字。", "𝄞.", "3.", "3.14,", "A1.", "'s.", "...", "www.a-b.com/x?y=1,", "ﬁ.", "q" * 90 + ".", "Ǆ,", "‍."]


@pytest.mark.parametrize("cache", [0, 3000, 10_000_000])
def test_ids_are_the_tokenizers_whatever_the_cache(cache):
    from tokenizers import Tokenizer
    rng = random.Random(cache)
    whole = Tokenizer.from_file(PATH)
    encoder = tokens.WordEncoder(whole, cache)
    for _ in range(12):
        texts = ["".join(rng.choice([*AWKWARD, "The", "word", "Word.", "über,"]) + rng.choice([" ", "\n", "  ", " \n", ""]) for _ in range(rng.randint(0, 25)))
                 for _ in range(40)] + [None, "", " ", "\n\n"]
        ids, counts = encoder.texts(pa.array(texts, pa.string()))
        want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [x for w in want for x in w]
    assert encoder.size() <= max(cache, 1) + 60_000
    assert len(encoder.hash) == len(encoder.slot) == len(encoder.word) == len(encoder.ids) == len(encoder.used)


def test_a_clashing_hash_is_not_a_hit():
    encoder = tokens.WordEncoder(tokens._encoder(PATH).tokenizer)
    encoder.texts(pa.array(["alpha beta"], pa.string()))
    encoder.word.data[:] = ord("z")         # as if other words had the same hashes
    ids, _ = encoder.texts(pa.array(["alpha beta"], pa.string()))
    assert ids.tolist() == encoder.tokenizer.encode("alpha beta", add_special_tokens=False).ids


# near duplicates --------------------------------------------------------------------------------

def test_memory_of_one_verification_is_bounded():
    """8,000 texts of eleven shingles that differ in the last word, in the blocks a task gets."""
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 62, 10, dtype=np.uint64)
    blocks = -(-8000 // near.TEXT_BLOCK)
    rows = 2 * -(-8000 // blocks)           # the texts of two blocks
    sets = [np.sort(np.append(common, np.uint64(i))).tobytes() for i in range(rows)]
    group = pd.DataFrame({"key": [b"%d" % i for i in range(rows)], "set": sets, "copies": 1, "block": [i % 2 for i in range(rows)], "left": 0, "right": 1})
    tracemalloc.start()
    out = near._verified(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000_000 and len(out) == rows and (out["texts"] == rows // 2).all()


def test_links_of_many_short_texts(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(14)) + f" end{i}") for i in range(1500)]
    found = near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in found} == {0} and {r.n_links for r in found} == {1499}      # 10 of 12 shingles are shared


# HTML --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("page", ["<a " * 330_000, '<a b="' * 160_000, "<a b='>\"" * 120_000, "<!--" * 250_000, "<p" * 400_000, '<a "' * 250_000 + ">",
                                  "<style>" + "{" * 500_000, "<style>" + "/*" * 100_000, "<textarea>" * 100_000, "<td colspan=99>" * 3000])
def test_markup_that_never_ends_takes_linear_time(page):
    begun = time.perf_counter()
    html.text_of(page)
    assert time.perf_counter() - begun < 10


@pytest.mark.parametrize("page,text", [
    ("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td>3</table>", "ab    | c\n1 | 2 | 3"),
    ("<table><tr><td rowspan=2>x<td>l1<br>l2<tr><td>q</table>", "x | l1\n  | l2\n  | q"),
    ("<table><tr><td>a<td><ul><li>b<li>c</ul></table>", "a | - b\n  | - c"),
    ("<p>a<textarea>b &amp;\nc</textarea><p>d", "a\nb &\nc\n\nd"),
    ("<select><option>one<option>two</select>", "one\ntwo"), ("<svg><title>t</title><text>drawn</text></svg>", "drawn"),
    ("<math><mi>x</mi><mo>+</mo><mn>1</mn></math>", "x+1"),
    ("<style>.h, #i { display : none } p.k{visibility:hidden} @media print { .m {display:none} }</style><p class='a h'>1<p id=i>2<p class=k>3<p class=m>4<b class=k>5", "45"),
    ("<style>/* .x{display:none} */ .y{display:none}</style><p class=x>a<p class=y>b", "a"),
    ('<a title="a>b">link</a> 1 < 2', "link 1 < 2"), ("<b title='x>y' hidden>no</b>yes", "yes"),
    ("a <b title=\"q>c", "a c")])
def test_layout(page, text):
    assert html.text_of(page) == text


@pytest.mark.parametrize("n", [1, 100, 5000])
def test_text_does_not_depend_on_the_size_of_a_part(n):
    """Many comments in a style sheet, much white space before a value, and letters that grow in lower case."""
    assert html.text_of("<style>" + "/* c */" * n + ".y{display:none}" + "/*/" * n + ".z{display:none}</style><p class=y>a<p class=z>b<p>c") == "c"
    assert html.text_of(f'<a title={" " * n}"x>y">b</a>') == "b"
    for mark in ("i", "\u0130" * n):
        assert html.text_of("<script>1</\u017fcript>2</script>" + mark) == mark


def test_random_trees_against_a_plain_walk():
    """Words of visible text in order, from trees written out as markup."""
    rng = random.Random(6)
    kinds = ["div", "p", "ul", "b", "span", "section", "h2", "blockquote", "script", "noscript", "i"]

    def tree(depth):
        out, seen = [], []
        for _ in range(rng.randint(1, 4)):
            if depth and rng.random() < 0.6:
                kind, hidden = rng.choice(kinds), rng.random() < 0.15
                inner, words = ("var x", []) if kind == "script" else tree(depth - 1)
                if kind == "p":             # block elements would end it
                    inner, words = f"w{rng.randrange(99)}", None
                    words = [inner]
                inner = f"<li>{inner}</li>" if kind == "ul" else inner
                out.append(f"<{kind}{' hidden' if hidden else ''}>{inner}</{kind}>")
                seen += [] if hidden or kind in ("script", "noscript") else words
            else:
                word = f"w{rng.randrange(99)}"
                out.append(f" {word} ")
                seen.append(word)
        return "".join(out), seen

    for _ in range(200):
        page, words = tree(4)
        assert [w for w in html.text_of(page).replace("- ", " ").split() if w != "-"] == words
