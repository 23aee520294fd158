"""Packing: ids as the tokenizer gives them, gapless sequences, nearly as few as possible."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from assayloom.llm.packing import WordIds, encode, fullest, pack_documents, plan_bins, token_sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows, capacity=2048):
    coder = Tokenizer.from_file(PATH)
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            yield doc_id, piece, start, len(part), zlib.crc32(part.tobytes())


def check(packed, rows, capacity=2048, slack=1.02):
    got = sorted((tuple(r)[:5] for r in packed), key=str)
    assert got == sorted(plain_pieces(rows, capacity), key=str)
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for runs in bins.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in packed)
    assert len(bins) <= max(-(-total // capacity) * slack, -(-total // capacity) + 1)


def test_whole_table(table):
    docs = table("documents")
    check(pack_documents(docs, PATH).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (None, "null id"), (4, "same row"), (4, "same row"), (5, "Ünï cödé space  wide é ́x"),
    (6, "<|endoftext|> a<|startoftext|>b it's I'LL 1234 !!??"), (7, "word " * 5000), (8, "x" * 20_000), (9, "日本語 テキスト\x0b\x0c\x85\x1c混ざる"),
    (10, "İ ΣΣ ﬁ ß"),
]


def test_edges(documents):
    check(pack_documents(documents(ROWS), PATH).collect(), ROWS, slack=1.1)
    check(pack_documents(documents(ROWS), PATH, capacity=7).collect(), ROWS, 7, slack=1.1)
    assert pack_documents(documents([]), PATH).collect() == []
    clash = documents(ROWS).withColumnsRenamed({"lang": "piece", "source": "length", "n_chars": "id"})
    assert pack_documents(clash, PATH).count() > len(ROWS)


def test_sequences_hold_the_ids(documents):
    coder = Tokenizer.from_file(PATH)
    want = Counter()
    for _, text in ROWS:
        want.update([*coder.encode(text or "", add_special_tokens=False).ids, 0])
    got = Counter()
    for r in token_sequences(documents(ROWS), PATH, capacity=64).collect():
        assert len(r["ids"]) <= 64
        got.update(r["ids"])
    assert got == want


def test_fullest_against_all_subsets():
    rnd = random.Random(1)
    for _ in range(200):
        items = [rnd.randint(1, 30) for _ in range(rnd.randint(0, 10))]
        room = rnd.randint(0, 60)
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums}
        used = fullest(Counter(items), room)
        assert sum(x * n for x, n in used) == max(s for s in sums if s <= room)
        assert all(n <= items.count(x) for x, n in used)


def test_plan_uses_every_piece():
    rnd = random.Random(2)
    histogram = Counter(min(2048, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    used, bins = Counter(), 0
    for combination, times in plan_bins(histogram):
        assert sum(x * n for x, n in combination) <= 2048
        bins += times
        for x, n in combination:
            used[x] += n * times
    assert used == histogram
    assert bins <= 1.001 * sum(x * n for x, n in histogram.items()) / 2048 + 1


class Counting:
    """A tokenizer that counts the texts it gets; without ``ends`` its vocabulary does not mark where words end."""

    def __init__(self, ends=True):
        self.coder, self.ends, self.texts = Tokenizer.from_file(PATH), ends, 0

    def get_vocab(self):
        return {token if self.ends else token.replace("</w>", "_"): i for token, i in self.coder.get_vocab().items()}

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.coder.encode_batch_fast(texts, **options)


def test_plain_words_are_tokenized_together():
    rng = random.Random(5)
    plain = sorted({"".join(rng.choices("abcdefghijklmnoprstuvwxyzßàéèöøÿ", k=rng.randint(1, 14))) for _ in range(3000)})
    odd = ["don't", "a1b22", "İx", "ª", "µm", "x÷y", "e\u0301a", "</w>", "a</w>b", "<|endoftext|>", "日本", "ﬁ", "!?", "\u0301", "O'LL", "\xa0a\xa0"]
    mixed = plain + odd * 3
    rng.shuffle(mixed)
    texts = [" ".join(mixed[i : i + 97]) for i in range(0, len(mixed), 97)] + ["", "a", "a", " b\n\na "]
    whole = Tokenizer.from_file(PATH)
    for tokenizer, most in ((Counting(), 100), (Counting(ends=False), 4000)):
        ids, offsets = encode(pa.array(texts), WordIds(tokenizer))
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]
        assert tokenizer.texts < most
