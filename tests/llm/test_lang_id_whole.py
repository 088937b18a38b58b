"""Language identification learns all of the sampled documents: rare languages, many languages, contexts seen once."""

import random

import numpy as np
from pagewright.llm import lang_id
from test_python_operators import language_rows

SCHEMA = "doc_id long, text string, lang string"


def test_a_rare_language_without_repeated_grams(spark):
    rows = language_rows(200) + [(1000, "quiz jynx vex", "zz"), (1001, "quiz vex", None), (1002, "jynx", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.lang_pred for r in lang_id.identify(docs, train=docs).collect()}
    assert [got[i] for i in (1000, 1001, 1002)] == ["zz"] * 3
    alone = spark.createDataFrame([(1, "quiz jynx", "zz")], SCHEMA)
    assert lang_id.identify(alone, train=alone).first().lang_pred == "zz"


def test_more_languages_than_one_automaton_holds(spark):
    rng = random.Random(9)
    words = {f"l{k:02}": ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(4)] for k in range(70)}
    docs = spark.createDataFrame([(i, " ".join(w), lang) for i, (lang, w) in enumerate(words.items())], SCHEMA)
    assert [r for r in lang_id.identify(docs, train=docs).select("doc_id", "lang_pred").collect() if r.lang_pred != f"l{r.doc_id:02}"] == []


def test_every_context_of_a_large_sample_counts():
    """More contexts than a fixed table would hold: costs are those of plain PPM-C over all grams."""
    rng = random.Random(3)
    counts, raw = {}, {}
    for lang in ("aa", "bb", "cc"):
        raw[lang] = " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(6)) for _ in range(3000)).encode()
        data = b" " * lang_id.ORDER + raw[lang]
        counts[lang] = grams = {}
        for i in range(len(raw[lang])):
            grams[data[i : i + 5]] = grams.get(data[i : i + 5], 0) + 1
    model = lang_id.build(counts)
    text = raw["aa"][:1500] + b" " + raw["bb"][-1500:] + b" xyz"
    want = []
    for lang in model.langs:
        tree = {}
        for gram, n in counts[lang].items():
            for cut in range(5):
                own = tree.setdefault(gram[cut:4], {})
                own[gram[4]] = own.get(gram[4], 0) + n
        data, total = b" " * 4 + text, 0.0
        for i in range(len(text)):
            for cut in range(5):
                own = tree.get(data[i + cut : i + 4])
                if own and data[i + 4] in own:
                    total -= np.log2(own[data[i + 4]] / (sum(own.values()) + len(own)))
                    break
                if own:
                    total -= np.log2(len(own) / (sum(own.values()) + len(own)))
            else:
                total += np.log2(model.size)
        want.append(total)
    assert np.allclose(lang_id.code_lengths([text], model), [want])
