import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, toxicity
from tessera.llm.queries import fold, language_rows

SF = "/root/testdata/sf0.01"


def test_counts_of_long_texts_equal_those_of_one_block(monkeypatch):
    text = "Ab, cd!  éf 12 gh\n" * 50
    whole = language_id.counts(text)
    for block in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language_id, "_BLOCK", block)
        assert np.array_equal(language_id.counts(text), whole)
    assert language_id.counts("12 !") is None and language_id.counts("") is None


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, language_rows())
    got = language_id.identify(docs, model).where(fold(4) == 2).select("lang", "lang_pred", "score", "rejected").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 0.01 * len(got)
    far = spark.createDataFrame([(1, "中文 文字 只有" * 9), (2, "123 !"), (3, None), (4, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in language_id.identify(far, model).collect()}
    assert all(r.rejected for r in out.values()) and [out[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3
    assert out[1].lang_pred in {"en", "de", "fr", "es"}


GIBBERISH = {
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    "turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "swahili": "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri.",
    "vietnamese": "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi.",
    "italian": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
    "portuguese": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência.",
    "dutch": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, "
             "en behoren zich jegens elkander in een geest van broederschap te gedragen. Een ieder heeft aanspraak op alle rechten en "
             "vrijheden, zonder enig onderscheid van welke aard ook, zoals ras, kleur, geslacht, taal, godsdienst, politieke of andere "
             "overtuiging, nationale of maatschappelijke afkomst, eigendom, geboorte of andere status. Een ieder heeft het recht op leven, "
             "vrijheid en onschendbaarheid van zijn persoon. Niemand zal in slavernij of horigheid gehouden worden. Niemand zal onderworpen "
             "worden aan folteringen, noch aan een wrede, onmenselijke of onterende behandeling of bestraffing.",
    "lorem": "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "code": "static int foo(struct bar *p, size_t n) { for (int i = 0; i < n; i++) if (!p[i].x) return memcpy(&p[i], buf, n); }"}


def test_languages_reject_gibberish_and_unseen_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language_id.fit(docs, language_rows())
    rng = np.random.default_rng(1)
    words = lambda n, letters, size: " ".join("".join(rng.choice(list(letters), size)) for _ in range(n))
    bad = GIBBERISH | {"az": words(60, "abcdefghijklmnopqrstuvwxyz", 6), "few": words(8, "abcdefghijklmnopqrstuvwxyz", 6),
                       "consonants": words(40, "bcdfghjklmnpqrstvwxz", 6), "hex": words(1, "0123456789abcdef", 400),
                       "base64": words(1, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", 400)}
    assert {k for k, t in bad.items() if not model.predict(t)[2]} == set()
    got = language_id.identify(docs, model).where(fold(4) == 2).select("text", "rejected").collect()
    short = [r.rejected for r in got if len(r.text) < 40]
    assert sum(r.rejected for r in got) <= 0.003 * len(got) and len(short) >= 20 and not any(short)  # one word over and over
    clean = ["This.", "Nicht.", "Éaux.", "All human beings are born free and equal in dignity and rights.",
             "Alle Menschen sind frei und gleich an Würde und Rechten geboren."]
    assert not any(model.predict(t)[2] for t in clean)


def test_language_floor_of_a_band_comes_from_all_rows():
    """The more rows, the nearer to the quantile; few rows: all languages, then shorter bands; no rows, no floor."""
    class Rows:  # stands for the aggregate
        def __init__(self, found):
            self.found = found

        def __getattr__(self, _):
            return lambda *a: self

        def collect(self):
            return self.found

    from types import SimpleNamespace as R
    found = [R(lang="en", band=2, n=970, q=0.5, r=0.6), R(lang=None, band=2, n=2970, q=0.2, r=0.8), R(lang="en", band=1, n=3, q=0.9, r=0.1),
             R(lang=None, band=1, n=90, q=0.4, r=0.9), R(lang="en", band=3, n=10, q=0.9, r=0.1), R(lang=None, band=3, n=20, q=0.8, r=0.2)]
    floor, near = language_id._bounds(Rows(found), ["en"], np.zeros((1, 2)), np.ones(2), 0.1)["en"]
    assert np.allclose(near[:5], [1, *(1 - language_id.SOFT * x for x in (0.1 * 90 / 140, 0.4 * 970 / 1020, 0.4 * 990 / 1040, 0.4 * 990 / 1040))])
    assert np.allclose(floor[:5], [0, 0.4 * 90 / 110, 0.5 * 970 / 990, 0.5 * 990 / 1010, 0.5 * 990 / 1010])


def test_languages_of_one_row_and_equal_cosines(spark):
    """A language with a single row is learned; of equal centroids the first language by name is told, and not rejected."""
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(
        [("kaksi sanaa suomeksi täällä", "fi")] + [("one two three words", "en"), ("one two three words", "de")] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = language_id.fit(docs, F.lit(True))
    assert set(model.langs) == {"fi", "en", "de"}
    assert model.predict("kaksi sanaa suomeksi täällä")[0] == "fi" and model.predict("one two three words")[::2] == ("de", False)


def test_language_odd_rows(odd, empty, clash):
    model = language_id.fit(odd, F.lit(True))
    rows = language_id.identify(clash(odd), model).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} <= {"en", "fr", "und"}
    nothing = language_id.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(empty, model).collect() == []


def test_prediction_reads_only_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    model = language_id.fit(docs, F.lit(True))
    a = [r.lang_pred for r in language_id.identify(docs.orderBy("doc_id"), model).collect()]
    b = [r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit("xx")).orderBy("doc_id"), model).collect()]
    assert a == b


def test_nnpu_separates_and_keeps_the_prior():
    rng = np.random.default_rng(0)
    toxic = rng.random(4000) < 0.1
    rows = [np.array([0] if t else [], int) if rng.random() < 0.9 else np.array([1], int) for t in toxic]
    w, b = toxicity.nnpu([r for r, t in zip(rows, toxic) if t], rows, 2, 0.1)
    p = 1 / (1 + np.exp(-(b + w)))
    assert p[0] > 0.9 and p[1] < 0.5 and 1 / (1 + np.exp(-b)) < 0.1


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels, fold(5) != 0)
    got = toxicity.score(docs.join(labels, "doc_id").where(fold(5) == 0), model).select("score", "predicted", "toxic").collect()
    pos, neg = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert len(pos) > 50 and auc > 0.85 and np.mean([r.predicted for r in got if not r.toxic]) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_batches_are_bounded_by_features():
    """10,000 texts and one of 20 MB: no batch holds more than the bound and one text."""
    import pyarrow as pa
    texts = [f"some words of text number {'abcdefghij'[i % 10] * 5} and{'x' * (i % 50)}" for i in range(10_000)]
    texts.insert(5_000, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(4_000_000)))
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"row": [str(i) for i in range(n)], "p": [0] * n, "u": [1] * n, "bag": [0] * n, "text": texts})
    rows, most = 0, 0
    for out in toxicity.tokens(iter([batch])):
        sizes = out.column("words").value_lengths().to_pylist()
        assert sum(sizes[:-1]) < toxicity.HELD
        assert out.column("words")[0].as_py() == sorted(toxicity.features(texts[rows]))
        rows, most = rows + out.num_rows, max(most, out.nbytes)
    assert rows == n and most < 4 << 20


def test_toxicity_counts_equal_texts_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["good", "fine", "warm", "sunny", "river", "stone"], 6)) + (" vile" if i % 7 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(0, 400, 2)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    copies = docs.unionByName(docs.where("doc_id < 30").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("k"))
    a, b = (toxicity.fit(d, labels, F.lit(True)) for d in (docs, copies))
    assert a.weights.keys() == b.weights.keys() and "=vile" in a.weights
    assert a.bias == pytest.approx(b.bias) and all(b.weights[w] == pytest.approx(v) for w, v in a.weights.items())


def test_toxicity_odd_rows(spark, odd, empty, clash):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(clash(odd), labels, F.lit(True))
    rows = toxicity.score(clash(odd), model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    for d, lab in ((empty, labels), (odd, labels.where("false"))):
        m = toxicity.fit(d, lab, F.lit(True))
        assert m.weights == {} and 0 <= m.score(None) <= 1
    assert toxicity.score(empty, model).collect() == []
