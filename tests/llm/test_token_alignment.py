"""Token alignment against whole texts tokenised and compared pair by pair."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortwise.llm import alignment

SCHEMA = "doc_id long, text string, key string, copies int, n_a string, pairs int"


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(alignment.BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.byte = {c: b for b, c in chars.items()}

    def spans(self, ids, size):
        at, out = 0, []
        for i in ids:
            out.append((at, at + size(i)))
            at += size(i)
        return out

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def text(self, text):
        """(a ids, b ids, groups, links) or None."""
        if not text:
            return None
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(self.a_bytes, a)) != whole or b"".join(map(self.b_bytes, b)) != whole:
            return None
        sa, sb = self.spans(a, lambda i: len(self.a_bytes(i))), self.spans(b, lambda i: len(self.b_bytes(i)))
        ends = {e for _, e in sa} & {e for _, e in sb}
        groups, group = [], ([], [])
        for end, side, i in sorted([(e, 0, i) for (_, e), i in zip(sa, a, strict=True)] + [(e, 1, i) for (_, e), i in zip(sb, b, strict=True)], key=lambda x: x[:2]):
            group[side].append(i)
            if side and end in ends:
                groups.append("|".join(",".join(map(str, ids)) for ids in group))
                group = ([], [])
        links, first = [], 0
        for (s, e), i in zip(sa, a, strict=True):
            while sb[first][1] <= s:
                first += 1
            j = first
            while j < len(sb) and sb[j][0] < e:
                links.append((i, b[j]))
                j += 1
        return a, b, groups, links

    def measures(self, rows):
        found = [self.text(r[1]) for r in rows]
        count = Counter(pair for f in found if f for pair in set(f[3]))
        most = defaultdict(int)
        for (i, _), n in count.items():
            most[i] = max(most[i], n)
        out = []
        for (doc_id, *_), f in zip(rows, found, strict=True):
            if f is None:
                out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
                continue
            a, b, groups, links = f
            n_best = sum(count[p] == most[p[0]] for p in links)
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((doc_id, len(a), len(b), len(groups), len(links), n_best, sum(count[p] for p in links), sha))
        return out


ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a b  ", "\n", "a\nb \tc", "x \r\n y", "<|endoftext|> a <s>b</s> <0x41> <unk>", "▁", "a ▁b c", "é ü 漢字 🙂 ẞ",
    "don't we'll I'M it's", "12 345 6789 ½ ²", "a\u00a0b\u3000c", "\u200bzero \ufeffwidth", "e\u0301 combining", "\x00nul \x1c sep", "under_score __x __", "a" * 3000,
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    alphabet = "abcdefgh  \n\t.,'-éß漢🙂1290_   "
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    texts += ["the quick brown fox jumps over the lazy dog " * 40] * 30
    rows = [(i, t, "k", 7, "n", 1) for i, t in enumerate(texts)]
    return rows + rows[:20] + [(None, "the null id", None, None, None, None)]


def measured(frame, settings=alignment.Settings()):
    return sorted([tuple(r) for r in alignment.alignment_measures(frame, settings).collect()], key=str)


@pytest.fixture(scope="module")
def want(rows):
    return sorted(Plain().measures(rows), key=str)


def test_against_plain_alignment(spark, rows, want):
    assert measured(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want


def test_small_pieces_full_caches_and_several_count_tables(spark, rows, want):
    settings = alignment.Settings(piece=40, chunks=50, count_rows=200)
    assert measured(spark.createDataFrame(rows, SCHEMA).repartition(2), settings) == want


def test_groups_and_pairs(spark):
    plain = Plain()
    texts = ["hello wide world", "naïve café 漢字", "hello wide world", None, ""]
    found = alignment.aligned_texts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    by_key = {r.key: r for r in found}
    assert len(found) == 2
    for text, copies in ((texts[0], 2), (texts[1], 1)):
        r = by_key[hashlib.sha256(text.encode()).hexdigest()]
        a, b, groups, links = plain.text(text)
        assert (r.copies, r.n_a, r.n_b, r.groups) == (copies, len(a), len(b), ";".join(groups))
        assert Counter({(p >> 32, p & 0xFFFFFFFF): t for p, t in zip(r.pairs, r.times, strict=True)}) == Counter(links)


def test_a_very_long_text(spark):
    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(200_000))
    frame = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    whole = measured(frame, alignment.Settings(piece=1 << 30))
    assert measured(frame) == whole and whole[0][1] > 200_000


def test_empty_and_invalid(spark):
    assert measured(spark.createDataFrame([], SCHEMA)) == []
    broken = spark.range(1).selectExpr("id as doc_id", "cast(x'61ff20' as string) as text")
    assert measured(broken) == [(0, 0, 0, 0, 0, 0, 0, "")]
