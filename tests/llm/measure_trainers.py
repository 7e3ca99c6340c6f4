"""What zstandard's dictionary trainer gives on raw text, beside the dictionaries of op1 and op10: the AUC on held-out labels.

    python tests/llm/measure_trainers.py [folder of tables]
"""

import os
import sys
from collections import Counter

import duckdb
import numpy as np
import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
from corpusloom.llm import lm_scoring, toxicity  # noqa: E402


def auc(yes, no):
    x = np.array([*yes, *no], float)
    s = np.sort(x)
    rank = (np.searchsorted(s, x, "left") + np.searchsorted(s, x, "right") + 1) / 2
    return round(float((rank[: len(yes)].sum() - len(yes) * (len(yes) + 1) / 2) / (len(yes) * len(no))), 3)


def halves(rows, flag):
    for k in (1, 0):
        texts = [r[1] for r in rows if r[flag] == k]
        yield texts[: len(texts) // 2][:1500], texts[len(texts) // 2 :][:1000]


def words(text, n=32):
    w = text.lower().split()
    return [" ".join(w[i : i + n]).encode() for i in range(0, len(w), n)]


def main(folder):
    rows = duckdb.sql(f"SELECT doc_id, text, toxic, quality FROM '{folder}/documents.parquet' JOIN '{folder}/labels.parquet' USING (doc_id) WHERE text <> '' ORDER BY hash(doc_id)").fetchall()
    (toxic, toxic_held), (plain, plain_held) = halves(rows, 2)
    for size in (4096, 16_384, 112_640):
        c = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.train_dictionary(size, [w for t in texts for w in words(t)][:40_000]), write_content_size=False).compress for texts in (toxic, plain)]
        score = lambda t: max([len(c[1](w)) - len(c[0](w)) for w in words(t)])
        print("op1, trainer on raw text,", size, "bytes: AUC", auc([score(t) for t in toxic_held], [score(t) for t in plain_held]), flush=True)
    model = toxicity.Model(*toxicity._dictionaries(toxic, plain, toxicity.ORDINARY_WORDS), toxicity.WINDOW, 8)
    score = model.scorer()
    d = [[score(t)[0] for t in texts] for texts in (toxic_held, plain_held)]
    print("op1, trainer on word codes: AUC", auc(*d), "caught of", len(d[0]), "and flagged of", len(d[1]), "at cuts", {cut: [sum(x >= cut for x in y) for y in d] for cut in range(4, 12)})

    (good, good_held), (poor, poor_held) = halves(rows, 3)
    general = [r[1] for r in rows if r[1] in set(good) | set(poor)]

    def heaviest(texts, size):
        c = Counter(w for t in texts for w in t.split())
        out, used = [], 0
        for w in sorted(c, key=lambda w: (-c[w] * len(w.encode()), w)):
            if used + len(w.encode()) + 1 > size:
                break
            out.append(w)
            used += len(w.encode()) + 1
        return "".join(w + " " for w in reversed(out)).encode()

    for size in (16_384, 112_640):
        trained = [zstandard.train_dictionary(size, [w for t in texts for w in words(t)][:40_000]).as_bytes() for texts in (good, general)]
        for name, pair in (("trainer on raw text", trained), ("heaviest words", [heaviest(good, size), heaviest(general, size)])):
            a, b = map(lm_scoring.sizer, pair)
            score = lambda t: (b(t.encode()) - a(t.encode())) / max(1, b(t.encode()))
            print("op10,", name + ",", size, "bytes: AUC", auc([score(t) for t in good_held], [score(t) for t in poor_held]), flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
