"""Small tables with every awkward case, and plain versions of what the operators compute."""
import random

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType()),
                   # names that operators use inside
                   *[StructField(c, StringType()) for c in ("d1", "row", "label", "component", "piece", "n", "line")]])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()),
                     StructField("toxic", IntegerType())])
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward_texts():
    rng = random.Random(7)
    long_text = "\n".join(sentence(rng, 12) for _ in range(3000))
    base = sentence(rng, 80)
    return [None, "", " \n\t", "Alpha", "alpha beta gamma", base, base, base.upper(), base.replace(" ", "  "),
            base + " tail", long_text, long_text + " end", "x\n\nx\r\n X \n", "<|end|> <|endoftext|> ΑΣ, d'accord\x00",
            "é" * 5000, "12 34 !!", *[f"shared line\n{sentence(rng, 9)}\n  Shared LINE\t" for _ in range(12)]]


def frame(spark, texts=None, ids=None):
    texts = awkward_texts() if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), *("z",) * 7) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward_frame(spark):
    """The awkward texts, then rows without an id and rows that repeat an id and text."""
    texts = awkward_texts()
    return frame(spark, texts + ["no id", "no id", texts[5]], [*range(len(texts)), None, None, 5])


def shingle_set(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def components(texts, width, similar=80):
    """Smallest index reachable, by comparing all pairs."""
    sets = [shingle_set(t, width) for t in texts]
    low = list(range(len(texts)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= similar * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                low[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]
