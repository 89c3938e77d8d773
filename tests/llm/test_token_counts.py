from tokenizers import Tokenizer, models

from auric.llm import token_counts as m
from tests.llm.conftest import SF, edge_texts, table


def test_counts_equal_a_unigram_tokenizer(spark):
    """The same vocabulary and scores in an independent unigram implementation."""
    v = m.Vocabulary.load()
    other = Tokenizer(models.Unigram([("<unk>", 0.0), *v.score.items()], unk_id=0)).model

    def count(word):
        return sum(1 if e.id else len(e.value.encode()) for e in other.tokenize(m.SPACE + word))

    rows = m.op1_token_counts(spark, SF).collect()
    texts = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    assert len(rows) == len(texts)
    for r in rows[::5]:
        ws = [w.decode() for w in texts[r.doc_id].encode().split()]
        assert (r.n_pretokens, r.n_tokens) == (len(ws), sum(map(count, ws)))


def brute(v, text):
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        options = []
        for begin in range(end):
            s = v.score.get(text[begin:end])
            more = 1
            if s is None and begin == end - 1:
                s, more = v.unknown, len(text[begin].encode())
            if s is not None:
                options.append((best[begin][0] + s, -best[begin][1] - more))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_long_words_use_the_same_recurrence(monkeypatch):
    v = m.Vocabulary.load()
    words = ["international" * 5, "x" * 90, "漢字é" * 20, "a"]
    whole = [m.Trie(v).insert(w.encode()) for w in words]
    assert whole == [brute(v, m.SPACE + w) for w in words]
    monkeypatch.setattr(m, "LONG", 3)
    assert [m.Trie(v).insert(w.encode()) for w in words] == whole


def test_a_full_trie_starts_anew(monkeypatch):
    v = m.Vocabulary.load()
    words = [f"word{k}{k * k}".encode() for k in range(200)]
    want = sum(m.Trie(v).insert(w) for w in words)
    monkeypatch.setattr(m, "TRIE_NODES", 50)
    assert m.Trie(v).count(words) == want


def test_edges(edge_docs, no_docs):
    rows = m.token_counts(edge_docs).collect()
    assert len(rows) == len(edge_texts())
    by = {(r.doc_id, r.n_bytes): r for r in rows}
    assert by[(3, 0)].n_tokens == by[(4, 0)].n_tokens == by[(5, 6)].n_tokens == 0
    assert by[(10, 300_000)].n_pretokens == 1 and by[(10, 300_000)].n_tokens > 0
    assert m.token_counts(no_docs).collect() == []
