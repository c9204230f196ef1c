"""Text operators without Spark: exact rules, round trips, brute force."""

import random

import numpy as np
import pytest

from biblioflow.llm import _text, bitext, chunks, language, leaks, mojibake, names, neardup, scans, tokens

ENC = tokens.encoder()


@pytest.mark.parametrize("text", ["", "Ação, ÇA 12a! ß İ ﬁ", "áb ç", "日本語 текст १२", "x" * 50 + "\U0001d400 \U0001f600z", "_a_b-c'd"])
def test_words_agree_with_their_hashes(text):
    h, n = _text.word_hashes([text, None, text])
    w = _text.words(text)
    assert n.tolist() == [len(w), 0, len(w)]
    assert len(set(h.tolist())) == len(set(w))


def test_hashes_do_not_depend_on_position():
    a, _ = _text.word_hashes(["alpha beta"])
    b, _ = _text.word_hashes(["x " * 700_000 + "beta alpha"])
    assert set(a.tolist()) == set(b[-2:].tolist())


@pytest.mark.parametrize("text", ["", "a b", "<|endoftext|> x", "  many   blanks \n\n\t x", "é" * 30_000, "word " * 20_000, "no blanks" + "x" * 25_000, "ends with blank "])
def test_pieces_encode_like_the_whole(text):
    assert sum((ENC.encode_ordinary(p) for p in tokens.safe_pieces(text, 100)), []) == ENC.encode_ordinary(text)
    assert tokens.decode(tokens.encode(text)).decode() == text
    assert tokens.encode(None) == []


def test_safe_pieces_on_random_text():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab1 é\n\t.'s-  ") for _ in range(rng.randint(0, 300)))
        assert sum((ENC.encode_ordinary(p) for p in tokens.safe_pieces(text, rng.randint(1, 40))), []) == ENC.encode_ordinary(text)


@pytest.mark.parametrize("text", ["One. Two! " * 900, "word " * 6000, "x" * 9000, "日本" * 3000, ("A paragraph, here; and there.\n" * 5 + "\n") * 90, "\n" * 9000, " a" * 3000 + "b" * 5000])
def test_pieces_tile_the_text_within_the_limit(text):
    for limit, overlap in ((2048, 128), (64, 8), (50, 0)):
        got = chunks.split_text(text, ENC, limit, overlap)
        assert got[0][:2] == (0, 0) and got[-1][2] == len(text)
        for (_, _, stop, _), (start, own, _, _) in zip(got, got[1:]):
            assert own == stop and start <= own
            assert chunks.count_tokens(text[start:own], ENC) <= overlap
        assert all(n <= limit and n == chunks.count_tokens(text[a:b], ENC) for a, _, b, n in got)


UNBROKEN = ["x" * 30_000, "日本語" * 5000, "é" * 20_000, "\n" * 9000, " " * 200 + "a" + (" " * 200 + "bc") * 2000, ("=" * 300 + "\n") * 600, "\U0001f600" * 3000]


@pytest.mark.parametrize("text", [*UNBROKEN, "word " * 6000, "One. Two! " * 900])
def test_seams_hold_the_whole_overlap_unless_a_word_starts(text):
    got = chunks.split_text(text, ENC)
    assert len(got) > 1
    for (before, _, stop, _), (start, own, _, _) in zip(got, got[1:]):
        n = chunks.count_tokens(text[start:own], ENC)
        assert own == stop and before <= start and n <= chunks.OVERLAP
        edge = start == 0 or text[start - 1].isspace() != text[start].isspace()
        # one more character would be too much where the start is inside a word
        assert n >= 64 and (edge or chunks.count_tokens(text[start - 1 : own], ENC) > chunks.OVERLAP)


def test_seams_of_a_whole_table():
    pq = pytest.importorskip("pyarrow.parquet")
    path = "/root/testdata/sf0.01/documents.parquet"
    if not __import__("os").path.exists(path):
        pytest.skip("no test tables")
    for text in pq.read_table(path, columns=["text"])["text"].to_pylist():
        if not text or chunks.count_tokens(text, ENC, chunks.LIMIT) <= chunks.LIMIT:
            continue
        got = chunks.split_text(text, ENC)
        assert max(n for *_, n in got) <= chunks.LIMIT and (got[0][0], got[-1][2]) == (0, len(text))
        for start, own, _, _ in got[1:]:
            n = chunks.count_tokens(text[start:own], ENC)
            assert n == chunks.OVERLAP or n > 64 and text[start - 1].isspace() != text[start].isspace()


def test_small_texts_are_one_piece():
    assert chunks.split_text(None, ENC) == [] and chunks.split_text("", ENC) == []
    assert chunks.split_text("short", ENC) == [(0, 0, 5, 1)]


def test_merging_prefers_strong_boundaries():
    text = ("aa bb cc dd ee. " * 4 + "\n\n") * 6
    got = chunks.split_text(text, ENC, 60, 0)
    assert all(text[own - 1] == "\n" for _, own, _, _ in got[1:])


def test_early_stop_is_exact():
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice(["palavra ", "é", "x", "1234 ", "\n"]) for _ in range(rng.randint(100, 2500)))
        assert (chunks.count_tokens(text, ENC, 500) <= 500) == (len(ENC.encode_ordinary(text)) <= 500)


def test_winnowing_guarantee():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(9)]
    for _ in range(200):
        a = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        b = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        if rng.random() < 0.6 and len(b) >= 12:
            i, j = rng.randint(0, len(a)), rng.randint(0, len(b) - 12)
            a[i:i] = b[j : j + rng.randint(10, 12)]
        want = any(a[i : i + 12] == b[j : j + 12] for i in range(len(a) - 11) for j in range(len(b) - 11))
        ga, gb = (leaks._winnow(*_text.word_hashes([" ".join(x)]), 6, 7)[0] for x in (a, b))
        assert not want or set(ga.tolist()) & set(gb.tolist())
        assert (leaks.longest_shared_run(a, b) >= 12) == want


def test_circulant_signatures_estimate_similarity():
    rng = random.Random(4)
    for share in (0.3, 0.6, 0.9):
        words = [f"t{rng.random()}" for _ in range(400)]
        n = int(400 * share / (1 + share) * 2)
        a, b = words[:n] + words[n : (n + 400) // 2], words[:n] + words[(n + 400) // 2 :]
        h, doc = neardup._distinct_words([" ".join(a), " ".join(b)])
        _, keys = neardup.signature_bands(h, doc, 1, 400)
        true = len(set(_text.words(" ".join(a))) & set(_text.words(" ".join(b)))) / len(set(_text.words(" ".join(a))) | set(_text.words(" ".join(b))))
        assert abs(np.mean(keys[:, 0] == keys[:, 1]) - true) < 0.1


def test_bands_find_records_at_the_threshold():
    rng = random.Random(5)
    texts = []
    for _ in range(1000):
        words = [f"t{rng.random()}" for _ in range(40)]
        texts += [" ".join(words[:33]), " ".join(words[7:])]  # 26 of 40 in common
    h, doc = neardup._distinct_words(texts)
    _, keys = neardup.signature_bands(h, doc)
    assert (keys[:, ::2] == keys[:, 1::2]).any(0).mean() > 0.98


GARBLED = [
    ("educação física", "utf-8", "cp1252"), ("educação física à tarde", "utf-8", "latin-1"), ("avaliação", "utf-8", "mac_roman"), ("sobre a educação", "utf-8", "cp850"),
    ("análise de conteúdo", "cp1252", "cp850"), ("precisão das previsões", "cp1252", "cp1251"),
]


@pytest.mark.parametrize("text,meant,read", GARBLED)
def test_round_trips(text, meant, read):
    bad = text.encode(meant).decode(read)
    assert mojibake.repair(bad)[:2] == (text, True)
    assert mojibake.repair("Texto limpo. " + bad + " e mais.")[:2] == ("Texto limpo. " + text + " e mais.", True)


def test_nested_layers_and_entities():
    bad = "informação".encode().decode("cp1252").encode().decode("cp1252")
    assert mojibake.repair(bad) == ("informação", True, 2)
    assert mojibake.repair("computa&Atilde;&sect;&Atilde;&pound;o")[:2] == ("computação", True)
    assert mojibake.repair("visualizac¸˜ao do l´ıder")[:2] == ("visualização do líder", True)
    assert mojibake.repair("participac¸a˜o")[:2] == ("participação", True)


@pytest.mark.parametrize("text", ["", None, "plain", "AÇÃO E REAÇÃO", "étude", "“quotes” – dash… 1º nº 5", "naïve über", "a=1&b=2 http://a.b/x?q=1 Sim?Talvez", "soft\xadhyphen", "conﬁança", "¿Qué? ¡Sí!"])
def test_clean_text_stays(text):
    assert mojibake.repair(text)[:2] == (text, False)


def test_lost_characters_are_reported():
    for bad in ("confian�a", "num??riques", "educa?o", "\x93quoted\x94"):
        assert mojibake.repair(bad)[1]


def test_suspect_expression_misses_nothing():
    import re

    pattern = re.compile(mojibake.SUSPECT)
    for text, meant, read in GARBLED:
        assert pattern.search(text.encode(meant).decode(read))
    assert not pattern.search("Ação comum, “texto” – limpo: às 3ª, über? é!")


@pytest.mark.parametrize("label,want", [("pt_BR", "pt"), ("Português", "pt"), ("eng", "en"), ("es-419", "es"), ("Français", "fr"), ("xx", ""), (None, ""), (" ", ""), ("und", ""), ("de", "?")])
def test_labels(label, want):
    assert language.fold_label(label) == want


def test_string_kernel_on_held_out_sentences():
    train = {
        "pt": ["os alunos usaram uma ferramenta de leitura", "a escola não oferece muitas atividades", "este artigo apresenta um estudo sobre educação", "os dados foram coletados em três turmas"],
        "en": ["the pupils used a reading tool", "the school does not offer many activities", "this paper presents a study about education", "data were gathered in three classes"],
        "es": ["los alumnos usaron una herramienta de lectura", "la escuela no ofrece muchas actividades", "este artículo presenta un estudio sobre educación", "los datos fueron recogidos en tres grupos"],
        "fr": ["les élèves ont utilisé un outil de lecture", "l'école ne propose pas beaucoup d'activités", "cet article présente une étude sur l'éducation", "les données ont été recueillies dans trois classes"],
    }
    texts = [t for v in train.values() for t in v] * 3
    labels = [language.LANGUAGES.index(k) for k, v in train.items() for _ in v] * 3
    table = language.fit(texts, labels)
    test = ["os dados apresenta a leitura não", "the data about three pupils", "los datos sobre la lectura", "les données sur la lecture des élèves", ""]
    got = language.score(test, table)
    assert [language.LANGUAGES[k] for k in got[:4].argmax(1)] == ["pt", "en", "es", "fr"] and not got[4].any()


@pytest.mark.parametrize(
    "a,b,same",
    [
        (("Ana", "Maria", "Silva"), ("A.", "M.", "Silva"), True), (("Ana", "", "Silva"), ("Silva, Ana", "", ""), True), (("Ana", "", "Silva"), ("Silva", "", "Ana"), True),
        (("José", "de B.", "Lima"), ("Jose", "de Barros", "Llima"), True), (("Beto", "", "Souza"), ("ROBERTO", None, "SOUZA"), True), (("Ana", "", "Silva"), ("Ana", "", "Souza"), False),
        (("Ana", "", "Silva"), ("Carlos", "", "Silva"), False), (("Ana", "", "Silva Neto"), ("Ana", "", "Silva Filho"), False), (("", "", ""), ("", "", ""), False), ((None, None, "X"), ("Ana", "", "Silva"), False),
    ],
)
def test_person_names(a, b, same):
    given = frozenset({"ana", "jose", "carlos", "roberto"})
    assert names.same_person(names.readings(*a, given), names.readings(*b, given)) is same


def test_very_long_names_are_compared():
    many = " ".join(f"Nome{c * 4}" for c in "bcdfghjklmnpqrst")
    read = [names.readings("Ana", m, "Silveira", frozenset()) for m in (many, many.upper(), "Xavier " + many)]
    assert names.same_person(read[0], read[1]) and not names.same_person(names.readings("Ana", "Yvo", "Silveira", frozenset()), read[0])
    assert names.same_person(read[0], read[2])


def test_polynomial_assignment_is_the_cheapest():
    rng = random.Random(8)
    for _ in range(300):
        b = [rng.choice(["a", "an", "ana", "anna", "maria", "mario", "m", "jose", "ze", "lima", "lina"]) for _ in range(rng.randint(1, 6))]
        a = rng.sample(b, rng.randint(1, len(b)))
        a = [x[: rng.choice([1, 9])] for x in a] if rng.random() < 0.7 else rng.choices(["a", "jose", "limma", "mari"], k=len(a))
        assert abs(names.least_cost(tuple(a), tuple(b), names.person_cost) - names.assign(tuple(a), tuple(b), names.person_cost)[0]) < 1e-9


def test_deletes_find_every_single_edit():
    rng = random.Random(5)
    for _ in range(300):
        w = "".join(rng.choice("abcde") for _ in range(rng.randint(4, 9)))
        i = rng.randrange(len(w))
        v = rng.choice([w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])
        assert set(names.deletes(w)) & (set(names.deletes(v)) | {v})
        assert names.distance(w, v) <= 1


def test_typed_tokens_meet_the_tokens_they_may_stand_for():
    rng = random.Random(6)
    met = 0
    for _ in range(6000):
        name = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        v = name
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(v) + 1)
            v = rng.choice([v[:i] + v[i + 1 :], v[:i] + rng.choice("abz") + v[i:], v[:i] + "z" + v[i + 1 :], v[:i] + v[i : i + 2][::-1] + v[i + 2 :], v[:i], v[0:1] + "".join(c for c in v[1:-1] if rng.random() < 0.4) + v[1:][-1:]]) or name
        if names.place_cost(name, v) < 9:
            met += 1
            assert names.reach(name) & names.heard(v), (name, v)
    assert met > 3000


def test_uncommon_tokens_left_unsaid_come_last():
    form, words = [("universidade", "federal", "lupecor")], ["universidade", "federal", "luor"]
    assert names.organisation_cost(words, form, "", set(), frozenset(["lupecor"]))[0] == 3.3
    assert names.organisation_cost(words, [("universidade", "federal", "lunor")], "", {"lunor"}) == (1.0, [0, 1, 2])
    assert names.organisation_cost(["univ", "federal", "norte"], [("universidade", "federal", "norte")], "", set()) == (0.15, [0, 1, 2])



def test_sentences_as_stored():
    assert bitext.split_sentences("A b. C d?  E 3.5 f! g") == ["A b.", "C d?", "E 3.5 f!", "g"]
    assert bitext.split_sentences(None) == [] and bitext.split_sentences(" ") == []


def test_alignment_tolerates_order_merges_and_omissions():
    table = {"gato": {"cat": 0.9}, "dorme": {"sleeps": 0.9}, "casa": {"house": 0.9}, "vermelha": {"red": 0.9}, "chuva": {"rain": 0.9}, "forte": {"heavy": 0.9}}
    got = bitext.align("O gato dorme 12 horas. A casa vermelha tem 3 portas. Chuva forte.", "The red house has 3 doors; the cat sleeps 12 hours. Nothing else 99.", table)
    assert [(a, b) for a, b, _ in got] == [(1, 1), (2, 1)]
    assert bitext.align("O gato dorme 12 horas em Tobal.", "The dog of Gugar runs 77 miles with Zemar in 1999.", table) == []
    assert bitext.align(None, "x", table) == [] and bitext.align("x", "", table) == []


def test_added_sentences_do_not_unmake_a_translation():
    table = {"gato": {"cat": 0.9}, "dorme": {"sleeps": 0.9}, "casa": {"house": 0.9}, "vermelha": {"red": 0.9}, "chuva": {"rain": 0.9}, "forte": {"heavy": 0.9}}
    added = " Costs of 41, 42 and 43 coins in Zemar and Gugar stayed below 1999."
    assert [m[:2] for m in bitext.align("O gato dorme 12 horas. Chuva forte.", "The cat sleeps 12 hours." + added, table)] == [(1, 1)]
    assert [m[:2] for m in bitext.align("A casa vermelha. Chuva forte.", "Heavy rain." + added, table)] == [(2, 1)]
    assert [m[:2] for m in bitext.align("A casa vermelha. Chuva forte.", "Heavy rain, and 51 people of Zemar came in 1996." + added, table)] == [(2, 1)]
    assert bitext.align("O gato vermelho dorme 12 horas em Tobal.", "The cat of Gugar sleeps 77 hours with Zemar." + added, table) == []


def test_points_off_the_lines_are_noise():
    straight = [(i, i + i % 2) for i in range(8)]
    assert bitext._on_lines(straight, (8, 9), 1.0) == straight
    turned = [(i, i + 5) for i in range(4)] + [(i, i - 5) for i in range(5, 9)]  # two clauses that change places
    assert bitext._on_lines(turned, (9, 9), 1.0) == turned
    stray = [*straight[:4], (5, 0), *straight[6:]]
    assert bitext._on_lines(stray, (8, 9), 1.0) == [p for p in stray if p != (5, 0)]


def test_a_merged_sentence_shrinks_to_its_statement():
    w = np.zeros((20, 8), np.float32)
    w[np.arange(11, 19), np.arange(8)] = 1.0
    w[2, 3] = w[5, 6] = 1.0
    kept = bitext._shrunk(w, 1.0)
    assert kept[:6].sum() == 0 and kept[11:19].sum() == 8 and bitext._shrunk(w[11:19], 1.0).sum() == 8


def test_equal_sentences_are_paired_in_place():
    table = {"chuva": {"rain": 0.9}, "forte": {"heavy": 0.9}, "gato": {"cat": 0.9}, "dorme": {"sleeps": 0.9}}
    got = bitext.align("O gato dorme em Tobal. Chuva forte.", "Heavy rain. The cat sleeps in Tobal. Heavy rain.", table)
    assert (2, 3) in {m[:2] for m in got} and (2, 1) not in {m[:2] for m in got}


def _editor():
    words = "os alunos usaram uma ferramenta para apoiar a leitura digital nas escolas e os professores destacaram o principal benefício da motivação durante semanas de trabalho".split()
    clean = [" ".join(random.Random(i).sample(words, 16)) + "." for i in range(250)]
    counts = {w: 300 for w in words}
    return scans.Editor(scans.Words(counts)).fit(clean, ["Anais do Encontro de Tecnologias", "Letters on Classroom Computing"])


EDITOR = _editor()


@pytest.mark.parametrize(
    "bad,good",
    [
        ("os alunos usaram uma ferra-\nmenta para apoiar", "os alunos usaram uma ferramenta para apoiar"), ("nas esc\xadolas e os alunos usaram", "nas escolas e os alunos usaram"),
        ("os p r o f e s s o r e s usaram", "os professores usaram"), ("os prof ess ores usaram a leitura", "os professores usaram a leitura"),
        ("o princip@l bencfício da motiv@ção", "o principal benefício da motivação"), ("a leitura digital\n\x0c[586]\nnas escolas e os alunos", "a leitura digital nas escolas e os alunos"),
        ("a leitura digital\nAnais do Encontro de Tecnologias, 1994\nnas escolas e os alunos", "a leitura digital nas escolas e os alunos"),
    ],
)
def test_scan_repair(bad, good):
    got, n = EDITOR.repair(bad)
    assert got == good and n > 0


@pytest.mark.parametrize("text", [None, "", "os alunos usaram\na leitura digital nas escolas.", "nomes Brapajetal, R. e Doxarim, A. usaram", "os alumnos usarm a leitra digitl"])
def test_scan_repair_leaves_the_rest(text):
    assert EDITOR.repair(text)[1] == 0


@pytest.mark.parametrize("header", ["Revista de Leitura Digital · 1987", "Page 31", "Motivação de Professores / Trabalho, 2003", "1203 – Encontro de Leituras Digitais"])
def test_furniture_of_any_form_inside_a_line(header):
    got, n = EDITOR.repair(f"os alunos usaram a leitura {header} digital nas escolas")
    assert got == "os alunos usaram a leitura digital nas escolas" and n == 1


def test_number_in_brackets_next_to_a_digit():
    assert EDITOR.repair("os alunos usaram [586] 12 escolas")[0] == "os alunos usaram 12 escolas"


def test_furniture_inside_a_line_is_decided_by_the_perceptron():
    refs = [f"Silva, A. Leitura digital nas escolas. {t}, {y}. p. {y - 1900}." for t in ("Revista de Leitura Digital", "Anais do Encontro") for y in range(1980, 2020)]
    editor = scans.Editor(EDITOR.words).fit(refs, ["Anais do Encontro de Tecnologias"])
    assert editor.repair("Souza, B. Leitura nas escolas. Revista de Leitura Digital, 1999. p. 77.")[1] == 0
    assert editor.repair("Silva, A. Leitura Anais do Encontro de Tecnologias, 1999 digital nas escolas.")[1] == 1


def test_mistyped_suffix():
    given = frozenset({"vinicius"})
    a = names.readings("Vinícius", None, "Dinel leto", given)
    assert names.same_person(a, names.readings("V.", "", "Dinel Neto", given))
    assert not names.same_person(a, names.readings("V.", "", "Dinel Filho", given))


def _scan_editor():
    rng = random.Random(4)
    words = ["educação", "informática", "tecnologia", "português", "sistema", "aluno", "professor", "escola", "leitura", "currículo", "benefício", "programação"]
    clean = [" ".join(rng.choices(words, k=rng.randint(12, 40))).capitalize() + "." for _ in range(300)]
    return scans.Editor(scans.Words({w: 400 for w in words})).fit(clean, ["Anais de Escola e Tecnologia"]), words


def test_the_editor_joins_lines_and_keeps_paragraphs():
    editor, words = _scan_editor()
    one = " ".join(words[:6]) + "\n" + " ".join(words[6:9]) + " informá-\ntica " + " ".join(words[9:]) + "."
    got, edits = editor.repair(one + "\n\n" + one.capitalize())
    line = one.replace("-\n", "").replace("\n", " ")
    assert got == line + "\n\n" + line.capitalize() and edits == 2


def test_soft_hyphens_of_a_wrong_encoding_are_no_cuts():
    editor, words = _scan_editor()
    assert editor.repair("escola informá\xadtica leitura")[1] == 1
    assert editor.repair("escola e currículo e benefício".encode().decode("latin-1"))[1] == 0


def test_parts_know_every_piece():
    parts = scans.Parts(["informatica", "escola"])
    assert all(w[i:j] in parts for w in ("informatica", "escola") for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w))
    assert "i" not in parts and sum(f"zq{i}x" in parts for i in range(1000)) < 200
