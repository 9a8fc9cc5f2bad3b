import random
import re
import zlib

import numpy as np
import pytest

from marquee.llm import compression, pseudo_likelihood, template


def toxic_corpus(n, seed=1):
    """Syllable prose; every third text is toxic and holds some of a few words."""
    rng = random.Random(seed)
    parts = ["an", "the", "er", "on", "ing", "to", "re", "st", "ou", "le"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 3)))
    rows, labels = [], []
    for k in range(n):
        found = [word() for _ in range(rng.randint(40, 120))]
        toxic = int(k % 3 == 0)
        for _ in range(rng.randint(2, 5) * toxic):
            found[rng.randrange(len(found))] = rng.choice(["zwackel", "grumblix", "vortnik"])
        rows.append((k, " ".join(found)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_toxic_texts_are_found_in_held_out_rows(table, spark):
    rows, labels = toxic_corpus(900)
    rows += [(5000, None), (5001, ""), (None, "grumblix vortnik zwackel"), (5002, "the on re " * 20000), (7, rows[7][1])]
    docs = table(rows)
    model = compression.train(compression.training_sample(docs, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")))
    found = compression.scored(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    scores = {r.doc_id: r.score for r in found}
    held = [(scores[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = [(s >= compression.PREDICTED) == bool(y) for s, y in held]
    assert np.mean(right) > 0.95
    assert scores[None] >= compression.PREDICTED and max(scores[5000], scores[5002]) < 0.5
    assert scores[5000] == scores[5001]


def test_held_out_labels_train_nothing(table, spark):
    rows, labels = toxic_corpus(300)
    turned = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    schema = "doc_id bigint, quality int, toxic int"
    samples = [compression.training_sample(table(rows), spark.createDataFrame(x, schema)) for x in (labels, turned)]
    assert samples[0] == samples[1] and samples[0]


def test_without_labels_all_scores_are_zero(table, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = table([(1, "a b"), (2, None)])
    model = compression.train(compression.training_sample(docs, none))
    assert model is None and [r.score for r in compression.scored(docs, model).collect()] == [0.0, 0.0]
    assert compression.scored(table([]), None).count() == 0


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(2)
    network = pseudo_likelihood.Network(np.zeros(pseudo_likelihood.CLASSES))
    network.tables, network.out, network.bias = (p.astype(np.float64) for p in network.parameters())
    rows = pseudo_likelihood.neighbours(rng.integers(1, 500, 30), np.repeat([0, 1], 15))
    target = rng.integers(0, pseudo_likelihood.CLASSES, 30)

    def loss():
        return -np.log(network.forward(rows)[1][np.arange(30), target]).mean()

    for p, g in zip(network.parameters(), network.gradients(rows, target)):
        flat, own = p.reshape(-1), g.reshape(-1)
        for at in np.argsort(-np.abs(own))[:5]:
            held = flat[at]
            flat[at] = held + 1e-5
            up = loss()
            flat[at] = held - 1e-5
            down = loss()
            flat[at] = held
            assert (up - down) / 2e-5 == pytest.approx(own[at], rel=1e-3)


def test_steps_of_a_batch_add_up():
    """A batch of many steps, with scores near and far apart, against probabilities of the whole batch in double precision."""
    rng = np.random.default_rng(2)
    prior = np.log(rng.dirichlet(np.ones(40)))
    for scale in (1, 60):
        network = pseudo_likelihood.Network(prior)
        network.out *= scale
        assert network.head()[1] == (scale == 1)
        n = 2 * pseudo_likelihood.STEP + 7
        rows = rng.integers(0, 512, (n, 4)) + np.arange(4) * 512
        target = rng.integers(0, 40, n)
        units = np.tanh(network.tables[rows].astype(float).sum(axis=1))
        scores = units @ network.out.astype(float) + network.bias
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        assert network.chances(rows, target) == pytest.approx(chance[np.arange(n), target], rel=1e-3)
        error = (chance - np.eye(40)[target]) / n
        tables = np.zeros(network.tables.shape)
        np.add.at(tables, rows, ((error @ network.out.T.astype(float)) * (1 - units * units))[:, None, :])
        for got, wanted in zip(network.gradients(rows, target), (tables, units.T @ error, error.sum(axis=0))):
            assert got == pytest.approx(wanted, abs=1e-4 * np.abs(wanted).max())


def test_neighbours_stay_inside_their_text():
    context = np.arange(1, 7)
    found = pseudo_likelihood.neighbours(context, np.array([0, 0, 0, 1, 1, 2])) - np.arange(4) * pseudo_likelihood.CONTEXTS
    assert found.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0], [0, 0, 5, 0], [0, 4, 0, 0], [0, 0, 0, 0]]


def test_shuffled_words_score_lower_and_counts_are_whole(table):
    rng = random.Random(1)
    sentence = "one two three four five six seven eight nine ten".split()
    rows = [(k, " ".join(sentence * rng.randint(3, 12))) for k in range(300)]
    mixed = sentence * 10
    rng.shuffle(mixed)
    rows += [(900, " ".join(mixed)), (901, " ".join(sentence * 10)), (902, None), (903, ""), (903, "")]
    tokens = pseudo_likelihood.tokenised(table(rows))
    counts = pseudo_likelihood.bucket_counts(tokens)
    assert counts.sum() == sum(len((t or "").split()) for _, t in rows)
    model = pseudo_likelihood.train(tokens)
    found = {r.doc_id: (r.n_words, r.log_likelihood) for r in pseudo_likelihood.scored(tokens, model).collect()}
    start = pseudo_likelihood.train(tokens, 0)
    before = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.scored(tokens, start).collect()}
    assert found[901][1] > found[900][1] + 50 and found[901][1] > before[901]
    assert found[902] == found[903] == (0, 0.0)
    # the sum of conditional log-probabilities, one position at a time
    text = next(r.tokens for r in tokens.where("doc_id = 901").collect())
    buckets = np.frombuffer(text, "<u2")
    vocab, flat = model
    network = pseudo_likelihood.Network(vocab.prior).load(flat)
    total = 0.0
    for k in range(len(buckets)):
        sides = [k - 2, k - 1, k + 1, k + 2]
        row = [(vocab.context[buckets[j]] if 0 <= j < len(buckets) else 0) + c * pseudo_likelihood.CONTEXTS for c, j in enumerate(sides)]
        chance = network.forward(np.array([row]))[1][0]
        total += np.log(chance[vocab.word_class[buckets[k]]]) + vocab.inside[buckets[k]]
    assert found[901][1] == pytest.approx(total, rel=1e-4)


def test_nothing_to_score(table):
    assert pseudo_likelihood.pseudo_likelihood(table([])).count() == 0
    assert [r.log_likelihood for r in pseudo_likelihood.pseudo_likelihood(table([(1, None)])).collect()] == [0.0]


PAGES = {
    '<html><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="content"><h2>Title &amp; more</h2><p>One  two\n'
    ' three<p>Four <b>five</b> six.<div class="share-box">Share</div><ul><li>a<li>b</ul></div><div id="comments"><p>Nice</p></div>'
    "<footer>f</footer></body></html>": "Title & more\nOne two three\nFour five six.\na\nb",
    "": "",
    "plain text": "plain text",
    '<article><header><h1>T</h1></header><p>x</p><form>f<input></form><script>if (a<b) "</p>"</script><aside>q</aside></article>after': "T\nx",
    "<article><p>a &lt; b < c</p></article>": "a < b < c",
    '<article><p title="x>y">q</p><!-- c --><table><tr><td>1<td>2<tr><td>3</table></article>': "q\n1\n2\n3",
    '<article><p>a<span class="ad">buy</span>b</p><div role="alert">stop</div><div class="cookieNotice">ok?</div><p>&eacute;&#233;&#x1F600;</p></article>': "ab\néé😀",
    "<article><p>open <b>bold<p>next</article><footer>x</footer>": "open bold\nnext",
    "<nav>only</nav><script>": "",
    '<body class="has-sidebar nav-open"><div id="header">Top</div><div class="post"><h1>Head</h1><div class="text with-sidebar"><p>One two three four.</p>'
    '<p>Five six seven eight.</p></div></div><div class="page-footer">f</div></body>': "Head\nOne two three four.\nFive six seven eight.",
    '<main><div class="entry-header"><h1>T</h1></div><p>x</p><section class="reader-comments"><p>c</p></section></main>': "T\nx",
}


def test_single_pages():
    for html, want in PAGES.items():
        _, blocks = template.parsed(html)
        assert template.main_text(blocks, template.page_root(blocks)) == want, html


def site_pages():
    """A site without any marks: slots and template text can only be told apart over its pages."""
    rng = random.Random(1)
    line = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(30))
    rows, want = [], []
    for k in range(20):
        own = [line() for _ in range(rng.randint(1, 6))]
        html = "<body><div class=t1><a href=/>Front</a> <a href=/n>News</a></div><div class=t2><h1>" + own[0] + "</h1>"
        html += "<p>Read our terms before you go on</p>" + "".join(f"<p>{x}</p>" for x in own[1:]) + "</div><div class=t3>Made by us</div></body>"
        rows.append((k, f"https://site.example/{k}", html))
        want.append((k, "\n".join(own)))
    return rows, want


def test_template_text_of_a_site_goes(spark):
    rows, want = site_pages()
    rows += [(100, None, "<p>no site</p>"), (101, "https://small.example/", "<p>alone</p>"), (102, "https://site.example/x", None), (None, "https://small.example/a", "<p>no id</p>")]
    rows.append(rows[3])
    want += [(100, "no site"), (101, "alone"), (102, ""), (None, "no id"), want[3]]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "url as site", "html as text", "1 as page", "2 as root")
    found = [(r.page_id, r.text) for r in template.extracted(pages).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert template.extracted(pages.where("1 = 0")).count() == 0


def test_tokens_of_a_class_share_their_vector(spark):
    rows, _ = site_pages()
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = template.classes(pages).collect()
    once = {r.token for r in found if r.n_pages == 20 and r.is_path}
    assert {"/body", "/body/div.t1", "/body/div.t2", "/body/div.t2/h1", "/body/div.t3"} <= once
    root = next(r.vector for r in found if r.token == "/body")
    assert template.text_token("/body/div.t2/p", "Read our terms before you go on") in {r.token for r in found if r.vector == root}


def test_near_copies_of_an_article_keep_their_shared_paragraphs(spark):
    shared = [f"Shared paragraph {k} of an article that many pages of the host carry." for k in range(3)]
    for tag in ("article", "main", 'div role="main"', "div", 'div class="t2"'):
        rows = []
        for k in range(20):
            paragraphs = [*shared, f"Edited paragraph number{chr(97 + k)} of this copy alone."]
            html = "<body><div class=top>Menu</div><" + tag + ">" + "".join(f"<p>{x}</p>" for x in paragraphs) + f"</{tag.split()[0]}></body>"
            rows.append((k, f"https://copies.example/{k}", html, "\n".join(paragraphs)))
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, want string")
        found = {r.page_id: r.text for r in template.extracted(pages).collect()}
        assert found == {k: want for k, _, _, want in rows}, tag


def tagged_site(n=24, banner=False):
    """Pages of one template whose tags say what is what, and their articles."""
    rng = random.Random(7)
    words = lambda k: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(k))
    rows, want = [], {}
    for k in range(n):
        own = [words(rng.randint(3, 60)) for _ in range(rng.randint(1, 6))]
        menu = "".join(f"<li><a href=/{w}>{w}</a></li>" for w in words(rng.randint(2, 6)).split())
        html = "<body>" + ("<div>" + words(4) + "</div>" if banner and k % 5 == 0 else "")
        html += f"<nav><ul>{menu}</ul></nav><header><p>{words(5)}</p></header><article><h1>{own[0]}</h1>"
        html += "".join(f"<p>{x}</p>" for x in own[1:]) + f"</article><aside><p>{words(6)}</p></aside><footer>&copy; {words(8)}</footer></body>"
        rows.append((k, f"https://tags.example/{k}", html))
        want[k] = "\n".join(own)
    return rows, want


@pytest.mark.parametrize("banner", [False, True])
def test_slots_come_from_classes_not_from_tags(spark, banner):
    rows, want = tagged_site(banner=banner)
    schema = "page_id bigint, url string, html string"
    assert {r.page_id: r.text for r in template.extracted(spark.createDataFrame(rows, schema)).collect()} == want
    plain = [(k, url, re.sub(r"(</?)(article|main|nav|header|footer|aside)(?=[\s>])", r"\1div", html)) for k, url, html in rows]
    found = {r.page_id: r.text for r in template.extracted(spark.createDataFrame(plain, schema)).collect()}
    if not banner:
        assert found == want
    else:  # a container more on some pages moves the slot; it is found again by its text
        long = [k for k in want if len(want[k]) > 100]
        assert len(long) > 12 and all(found[k] == want[k] for k in long)


def test_all_words_for_what_is_no_article_count():
    for word in ("adsense", "gdpr", "toast", "widgets", "crumbs", "promoted"):
        _, blocks = template.parsed(f"<article><p>own text</p><div class={word}>not own</div></article>")
        assert template.main_text(blocks, template.page_root(blocks)) == "own text", word


def test_no_chosen_string_is_dropped():
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choices(letters, k=9))
    plain, bad = [word("abcdefghij") for _ in range(300)], [word("klmnopqrst") for _ in range(600)]
    line = lambda: [rng.choice(plain) for _ in range(60)]
    texts, labels = [], []
    for k in range(600):
        found = line()
        for _ in range(20 * (k % 2)):
            found[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(found).encode())
        labels.append(k % 2)
    ordinary, toxic = compression.train_dictionaries(texts, labels)
    content = toxic[len(ordinary) - len(compression.TAIL) :]
    chosen, _ = compression.chosen_strings(*([t for t, y in zip(texts, labels) if y == label] for label in (1, 0)))
    assert len(chosen) > 500 and all(part in content for part in chosen)


def test_a_phrase_of_ordinary_words_is_found(table, spark):
    rng = random.Random(3)
    pool = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(400)]
    phrases = [" ".join(rng.sample(pool, 7)) for _ in range(4)]
    rows, labels = [], []
    for k in range(900):
        found = rng.choices(pool, k=60)
        if k % 3 == 0:
            found[20:20] = rng.choice(phrases).split()
        else:  # the same words, apart
            found += rng.sample(rng.choice(phrases).split(), 7)
            rng.shuffle(found)
        rows.append((k, " ".join(found)))
        labels.append((k, 1, int(k % 3 == 0)))
    docs = table(rows)
    model = compression.train(compression.training_sample(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    scores = {r.doc_id: r.score for r in compression.scored(docs, model).collect()}
    held = [(scores[i], y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(s >= 0.5) == bool(y) for s, y in held]) > 0.8  # 0.69 without phrases


def test_words_of_one_bucket_keep_their_own_counts(table):
    rng = random.Random(5)
    pool = [f"w{k}" for k in range(150_000)]
    rows = [(k, " ".join(rng.choices(pool, k=400) + ["often"] * 20)) for k in range(500)]
    tokens = pseudo_likelihood.tokenised(table(rows))
    model = pseudo_likelihood.train(tokens, 0)
    vocab, flat = model
    counts = {}
    keys = {r.doc_id: np.frombuffer(r["keys"], "<u8") for r in tokens.collect()}
    for own in keys.values():
        for key in own.tolist():
            counts[key] = counts.get(key, 0) + 1
    assert len(counts) == len({w for _, t in rows for w in t.split()})
    assert len(vocab.prior) > pseudo_likelihood.CLASSES and vocab.contexts > pseudo_likelihood.CONTEXTS
    network = pseudo_likelihood.Network(vocab.prior, vocab.contexts).load(flat)
    found = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.scored(tokens, model).collect()}
    totals = np.zeros(1 << pseudo_likelihood.BITS)
    for key, n in counts.items():
        totals[key >> 48] += n
    for k in (0, 7):
        bucket = (keys[k] >> np.uint64(48)).astype(int)
        chance = network.forward(pseudo_likelihood.neighbours(vocab.context[bucket], np.zeros(len(bucket), int), vocab.contexts))[1]
        share = np.array([counts[x] for x in keys[k].tolist()]) / totals[bucket]
        want = np.log(chance[np.arange(len(bucket)), vocab.word_class[bucket]]) + vocab.inside[bucket] + np.log(share)
        assert (share < 1).any() and found[k] == pytest.approx(want.sum(), rel=1e-5)


def test_long_strings_tell_stems_of_two_byte_letters():
    """The stem's short parts stand inside ordinary words too; only longer strings tell it apart."""
    rng = random.Random(8)
    syllables = ["eux", "ré", "ment", "oi", "aux", "pa", "elle"]
    plain = [" ".join("a" + "".join(rng.choices(syllables, k=3)) for _ in range(40)) for _ in range(60)]
    toxic = [t + " " + " ".join("réeux" + rng.choice(syllables) for _ in range(4)) for t in plain[:30]]
    parts, _ = compression.chosen_strings([t.encode() for t in toxic], [t.encode() for t in plain])
    assert parts and all("réeux".encode() in p for p in parts)
    assert compression.telling_part("réeuxoi".encode(), {" réeu".encode(), "réeux".encode()}) == " réeux".encode()
    assert compression.telling_part(b"ab", {b" ab"}) == b" ab" and compression.telling_part(b"ab", set()) == b""
