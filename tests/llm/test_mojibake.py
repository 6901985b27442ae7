import random

import pytest

from histrail.llm import mojibake as M

CLEAN = [
    "Der Empfänger übersprang die gültige Fassung während der Umstellung.", "La projection a réécrit l'état précédent après la clôture.", "La operación se anuló según el guion, mañana se hará.",
    "Aktarıcı kısmen son değişikliği gönderdi, düğümü işledi.", "Zespół zwolnił właściciela załącznika późno, prośba odrzucona.", "Сообщение отброшено, просьба проверить журнал за прошлую ночь.",
    "A instância ficou parada, a solicitação não confere.", "The café isn’t naïve – it costs €5 at 20 µs ± 3, m³ and ½.", "plain words without any sign", "処理 再試行 完了 🚨 ✅ →",
]
WRONG = {
    "utf8 as cp1252": lambda t: t.encode().decode("cp1252", "replace").replace("�", ""), "utf8 as latin-1": lambda t: t.encode().decode("latin-1"), "utf8 as cp1251": lambda t: "".join(M._table("cp1251")[b] for b in t.encode()),
    "utf8 as mac": lambda t: t.encode().decode("mac_roman"), "utf8 as cp437": lambda t: t.encode().decode("cp437"), "twice": lambda t: t.encode().decode("latin-1").encode().decode("latin-1"),
}


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(1)
    texts = [" ".join(r.choices(CLEAN, k=3)) for _ in range(400)]
    names = list(WRONG)
    wrong = {i: names[i % len(names)] for i in range(0, 400, 9)}
    rows = [(i, (t + " " + WRONG[wrong[i]](CLEAN[i % 8]) if i in wrong else t), "x") for i, t in enumerate(texts)]
    rows += [(1000, None, ""), (1001, "", ""), (1002, "\xa0", ""), (1003, "fo\xa0rm wi​th odd spa﻿ce", ""), (1006, "den \xa0gültigen Empfänger\xa0über", ""), (1004, "za�ek", ""), (1005, "é" * 30_000, ""), (1003, "fo\xa0rm wi​th odd spa﻿ce", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, restored string")
    return rows, texts, wrong, M.restore(df, "doc_id", "text").collect()


def test_found_and_restored(corpus):
    rows, texts, wrong, got = corpus
    assert len(got) == len(rows)
    found = {g.doc_id for g in got if g.wrongly_decoded}
    # the plain sentence has nothing to spoil
    want = {i for i in wrong if not CLEAN[i % 8].isascii()} | {1004}
    assert found >= {i for i in want if wrong.get(i) != "utf8 as cp1252"} and not found - want - {i for i in wrong}
    restored = {g.doc_id: g.restored for g in got}
    exact = [restored[i] == f"{texts[i]} {CLEAN[i % 8]}" for i in want - {1004} if wrong[i] != "utf8 as cp1252"]
    assert sum(exact) / len(exact) > 0.9
    for i in (1001, 1002, 1003, 1005, 1006):
        assert i not in found
    assert restored[1000] is None and restored[1001] == ""
    assert all(restored[i] == t for i, t in enumerate(texts) if i not in wrong)


def test_segments_against_brute_force():
    r = random.Random(2)
    import numpy as np

    for _ in range(200):
        x = [r.choice([-3.0, -1.0, 1.0, 2.0]) for _ in range(r.randrange(0, 25))]
        got = M.improbable_runs(np.array(x))
        assert all(sum(x[s:e]) > 0 for s, e in got) and all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
        best = max((sum(x[s:e]) for s in range(len(x)) for e in range(s + 1, len(x) + 1)), default=0)
        assert max((sum(x[s:e]) for s, e in got), default=0) == max(best, 0)
        # every positive element lies in a segment
        assert all(any(s <= i < e for s, e in got) for i, v in enumerate(x) if v > 0)


def _one(c: str, read: str, written: str) -> str | None:
    v = int(M._exchanged(c)[list(M._EXCHANGE).index((read, written))])
    return chr(v) if v else None


def test_inverse_mappings():
    assert M._as_utf8("Ã¼ber", "cp1252") == "über" and M._as_utf8("Ü nicht", "cp1252") == "Ü nicht"
    assert _one("ý", "cp1252", "cp1254") == "ı" and _one("\xa0", "cp1252", "cp437") == "\xa0" and _one("a", "cp1252", "cp437") == "a"
    assert _one("я", "cp1252", "cp437") is None


def test_oddness():
    for t in ("pr¸fen", "liberÛ", "m│ by", "Revisi≤n", "caf√©", "ÐÒÏÓØÂÁ", "EmpfΣnger", "Prⁿf", "cafÚ", "Ç98"):
        assert M.oddness(t) > 0, t
    for t in ("Ø 12 mm, 5 kΩ, 20 °C", "«CAFÉ» “x” ‘y’ d’été", "a≤b, x²", "┌──┐ │ x │", "Acme™ ½ €", "żółć", "TÜRKİYE'DE", "日本語 abc", "Ёлка"):
        assert M.oddness(t) == 0, t


#: Text that merely uses uncommon characters; none of it is in the corpus.
UNCOMMON = [
    "Crème brûlée à la carte: 12 £", "naïve façade — “œuvre” … fin", "Größe 5 µm ± 0,2 °C, § 4 der Satzung", "© 2024 Acme™ – 20€", "Příliš žluťoučký kůň úpěl ďábelské ódy", "Η γρήγορη αλεπού πηδάει πάνω από το σκυλί",
    "Tiếng Việt có rất nhiều dấu thanh", "∑ xᵢ² ≤ ∞, √2 ≈ 1.41, α ∈ ℝ, a≤b", "القطة تجلس على السجادة", "שלום עולם, מה שלומך", "สวัสดีชาวโลก", "こんにちは世界、テストです", "საქართველო მშვენიერია", "«СССР» и «США» — 20 лет…", "«CAFÉ», «ÉTÉ» et «THÉÂTRE»",
    "Það er þannig að ég veit þú ert góður maður", "Þetta reddast, æði góð hugmynd frá þér", "Ett rött äpple åt Åsa; smörgåsbord på Öland", "Őrült árvíztűrő tükörfúrógép", "Şişli'de güneşli bir gün, ığdır", "┌──────┬─────┐\n│Name  │Wert │\n├──────┼─────┤\n│Größe │ 5 m³│\n└──────┴─────┘",
    "¿Qué tal? ¡Olé! Año 2º, 3ª planta", "Hôtel « L’Été » — n° 5, 50 % de 3 500 €", "5 × 3 = 15; 10 ÷ 2; x² + y² = z²; ½ cup; 25 °F", "Łódź, Kraków; żółć; gęślą jaźń", "Дърво и ябълка; ћирилица: љубав, њега, џеп", "Ще ходим ли до морето?", "A→B ⇒ C ↔ D • item ‣ sub ▪ x ■ y",
    "Temperature: −5 °C … +10 °C, ΔT = 3 K, 5 kΩ, 10 µF", "Mañana “comillas” ‘simples’ „deutsche“ ‚einfach‘ ‹x› »y«", "Ça va? Où ça? Noël à Nîmes, cœur, Æther, Þór, ð", "100 ¥, 50 ¢, 20 ₺, 30 ₽, 5 ₹, £3", "TÜRKİYE'DE İSTANBUL", "Straße 5¼ Zoll, 3½\" Diskette, m³/h", "‰ † ‡ ¶ § ¤ ¦ ¬ ¯", "😀 emoji 👍🏽 test 🚨",
    "한국어 텍스트입니다", "中文文本，测试。", "हिन्दी पाठ", "ĝis revido, ĉu vi? ŝafo ĵaŭdo", "Ünïcödé Mëtal Ümläuts", "IJsland, één, café’s, coördinatie", "Būtų šalta žiemą; ėjęs; Rīga, Jūrmala, ķēve", "x ≠ y, p ∧ q ∨ ¬r, A ∩ B ∪ C, ∀x ∃y", "½ ⅓ ¾ ⁿ ₂ H₂O CO₂ m² km³",
    # written after the rules were settled
    "Rødgrød med fløde på Bornholm, ærø og ål", "În România, țara și orașul Brașov; ăsta-i bun", "Õhtul jõudis rüütel öösel koju, šokk", "L'àvia d'Eivissa va dir: «col·laboració», què?", "Їжак і ґава їдять свіжі ягоди; під’їзд", "Њутнове љуте џокеје ђак ћути", "Ζ=√(R²+X²), θ=45°, λ≈500 nm",
    "Preis: 1’250.– CHF (inkl. 7,7 % MwSt.) · Stück", "فارسی: سلام دنیا، ۱۲۳", "Ελλάδα & Κύπρος: 5 €/κιλό", "Übergrößenträger – Maßkrüge à 1 ℓ", "Ἀχιλλῆος οὐλομένην", "Kız çocuğu şöyle söyledi: ‘ığdır’ıın’", "J’ai reçu 3 œufs, 2 æufs; ÿ, Ÿ, ï", "Číslo účtu: 5 ks × 3 ± 2 §", "naïveté coöperate résumé; El Niño; São; Zoë",
    "Привет, мир! «Ёлки-палки» — №7; 5–6 °C", "Tschüß; ẞ; groß", "Dž, Lj, Nj; đak; čaša; žaba; šećer", "Øre Åse Æble: 10 øre", "Kapcsolódó §-ok: 5. § (2) bek. „idézet”", "¹ siehe Fußnote², ebd.³ – S. 12 ff.",
]


@pytest.fixture(scope="module")
def documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return df, M.pair_model(df, "text")


@pytest.mark.parametrize("times", [1, 10])
def test_uncommon_text_is_left_alone(documents, times):
    """Neither found nor changed, beside a small corpus and one ten times as large."""
    model = documents[1]
    restorer = M.Restorer(M.PairModel(model.codes, model.counts * times))
    wrong = [t for t in [*UNCOMMON, *CLEAN] for found, new, _ in [restorer.text(t)] if found or new != t]
    assert not wrong


def test_unseen_scripts_are_restored(documents):
    restorer = M.Restorer(documents[1])
    for t in ("日本語のテキスト", "สวัสดีชาวโลก", "საქართველო", "Příliš žluťoučký kůň úpěl", "ελληνικά κείμενο", "עברית שלום"):
        assert restorer.text(t.encode().decode("latin-1"))[:2] == (True, t)
    found, new, _ = restorer.text("Tiếng Việt có rất nhiều dấu".encode().decode("latin-1"))
    assert found and "Việt" in new and "rất nhiều dấu" in new


def test_found_alike_in_a_larger_corpus(documents):
    """What is found doesn't depend on how large the corpus is."""
    df, model = documents
    small, large = M.Restorer(model), M.Restorer(M.PairModel(model.codes, model.counts * 10))
    texts = [r.text for r in df.filter("text IS NOT NULL").collect()]
    here, there = [small.text(t)[0] for t in texts], [large.text(t)[0] for t in texts]
    assert sum(here) > 50 and sum(a != b for a, b in zip(here, there, strict=True)) <= 0.02 * sum(here)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert M.restore(none, "doc_id", "text").count() == 0


def test_rare_script_in_a_large_corpus(spark):
    """One text in a script that makes up less than 5e-7 of all pairs: every pair is counted, and what was spoiled is restored."""
    from pyspark.sql import functions as F

    text, rare = CLEAN[0] + " " + CLEAN[1], "ภาษาไทย"
    many = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    odd = spark.createDataFrame([(100_000, f"clean {rare} text"), (100_001, f"spoiled {rare.encode().decode('latin-1')} text")], "doc_id long, text string")
    model = M.pair_model(many.unionByName(odd), "text")
    assert model.total > 4_000_000 and 1 / model.total < 5e-7 and all(model.knows(c) for c in rare)
    got = {g.doc_id: g for g in M.restore(many.unionByName(odd), "doc_id", "text").filter("doc_id >= 100000").collect()}
    assert not got[100_000].wrongly_decoded and got[100_001].wrongly_decoded and got[100_001].restored == f"spoiled {rare} text"


def test_script_that_occurs_only_spoiled():
    """No character of it is known, but all its bytes are valid UTF-8."""
    import numpy as np

    wrong = "ภาษาไทย".encode().decode("latin-1")
    texts = [c for c in CLEAN for _ in range(200)] + [f"one {wrong} word"]
    codes, counts = np.unique(np.concatenate([M.pair_codes(f" {t} ") for t in texts]), return_counts=True)
    assert M.Restorer(M.PairModel(codes, counts.astype(float))).text(f"one {wrong} word")[:2] == (True, "one ภาษาไทย word")
