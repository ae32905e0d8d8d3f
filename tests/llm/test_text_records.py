"""Garbled text, addresses, entities and abuse on small fixtures."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from wayfold.llm import abuse, address, entities, mojibake

ADDRESS = "갤힘광역시 주덜구 날갱헐로2번길 13-5, 2층"
NAME = "달빛모퉁이 공중화장실"


@pytest.mark.parametrize("text", [ADDRESS, NAME])
def test_round_trips_are_found_and_restored(text):
    plain = text.encode()
    for wrong in ("latin-1", "mac_roman"):
        assert mojibake.repair(plain.decode(wrong)) == (True, text)
    twice = plain.decode("latin-1").encode().decode("latin-1")
    assert mojibake.repair(twice) == (True, text)
    assert mojibake.repair(text.encode("cp949").decode("latin-1")) == (True, text)
    assert mojibake.repair(text.encode("cp949").decode("gbk")) == (True, text)


@pytest.mark.parametrize("text", ["던딤샘 " + "리조트".encode().decode("latin-1"), "�떂�뫁", "??? ????", NAME.encode("utf-16-le").decode("utf-16-be")])
def test_partly_garbled_and_lost_text_is_found(text):
    assert mojibake.repair(text)[0]


@pytest.mark.parametrize("text", [None, "", "  ", NAME, ADDRESS, "Café Solén", "Mañana Taquería", "山들 수목원", "水月 한의원", "さくらんぼ 카페", "PÃO & Doce", "커피½잔", "꽃샘☆마당", "뷁커피", "왜? 카페", "①번 출구", "Zürn·Bäck 제과", "가나"])
def test_text_that_was_meant_is_no_case(text):
    assert mojibake.repair(text) == (False, None)


def test_garbled_cells(spark):
    bad = NAME.encode().decode("latin-1")
    df = spark.createDataFrame([(1, bad, None, "x"), (1, bad, None, "x"), (2, NAME, ADDRESS, "x"), (None, bad, bad, "x")], "id long, name string, address string, value string")
    assert {tuple(r) for r in mojibake.garbled_cells(df, "id", ["name", "address"]).collect()} == {(1, "name", bad, NAME)}
    assert mojibake.garbled_cells(df.limit(0), "id", ["name"]).count() == 0


SAME = [
    "갤힘광역시 주덜구 날갱헐로2번길 13-5",
    "갤힘시 주덜구 날갱헐 로 2번 길 13-5번지 (볼챙동), 3층 301호",
    "날갱헐로2길 １３－５ / 주덜구 / 갤힘",
    "13-5, Nalgaengheol-ro 2beon-gil, Judeol-gu, Gaelhim",
    "13-5 NALGAENGHEOL-RO 2BEON-GIL JUDEOL-GU",
    "우)10037 갤힘·주덜구·날갱헐로2번길 13의 5",
    "갤힘_주덜구_날갱헐로2번길 #013–5",
    "날갱헐로2번길 13-5 길눈구 갤힘",
]


def test_addresses_of_one_building_parse_alike():
    parsed = [address.parse(a) for a in SAME]
    assert {(p[0], *p[2:5]) for p in parsed} == {("nalgaengheol", 2, 13, 5)}
    for a in (None, "", " ", "갤힘 주덜구 날갱헐로", "갤힘 주덜구 날갱헐로2번길", ADDRESS.encode().decode("latin-1"), "N/A"):
        assert address.parse(a) is None


def test_same_building_with_misspelt_roads(spark):
    rows = [(i, f"갤힘 주덜구 날갱헐로 {i % 40 + 1}") for i in range(80)] + [(100 + i, f"갤힘 거촌구 맨소탐로 {i % 40 + 1}") for i in range(80)]
    rows += [(500, "갤힘 주덜구 날갱힐로 7"), (501, "갤힘 거촌구 맨쏘탐로 7"), (501, "갤힘 거촌구 맨쏘탐로 7"), (502, "갤힘 맨소탐로 7-1"), (503, None)]
    rec = address.parsed(spark.createDataFrame(rows, "id long, address string"), "id", "address")
    got = {tuple(r) for r in address.same_building(rec).collect()}
    want = {(i, i + 40) for i in range(40)} | {(100 + i, 140 + i) for i in range(40)} | {(6, 500), (46, 500), (106, 501), (146, 501)}
    assert got == want
    assert address.same_building(rec.limit(0)).count() == 0


def test_misspelling_of_large_support_and_long_chains_of_spellings(spark):
    """A misspelling with more than a third of the right one's support is linked; roads that are only alike in name are not."""
    rows = [(i, f"갤힘 주덜구 날갱헐로 {i % 10 + 1}") for i in range(60)] + [(100 + i, f"갤힘 주덜구 날갱힐로 {i % 10 + 1}") for i in range(24)]
    rows += [(200 + i, f"갤힘 거촌구 볼챙로 {i % 10 + 1}") for i in range(50)] + [(300 + i, f"갤힘 히탤군 뭄날텀로 {i % 10 + 1}") for i in range(40)] + [(400 + i, f"갤힘 길눈구 샌잼군로 {i % 10 + 1}") for i in range(40)]
    stems = ["가람솔", "나들벌", "두레터", "마루봉", "버들숲", "소리샘", "아침뜰", "조약돌", "초롱골", "큰바위", "푸른솔", "하늘재"]
    rows += [(500 + 10 * i + j, f"갤힘 구투군 {x}로 {j + 1}") for i, x in enumerate(stems) for j in range(8)]
    rec = address.parsed(spark.createDataFrame(rows, "id long, address string"), "id", "address")
    fixed = {r.road: r.canonical for r in address.canonical_roads(rec).collect()}
    assert fixed.get(address.romanize("날갱힐")) == address.romanize("날갱헐") and address.romanize("볼챙") not in fixed


def test_district_and_postcode_keep_buildings_of_one_road_name_apart(spark):
    """The records' own comparison decides: 중앙로 of two districts with their own postcodes is two roads."""
    rows = [(i, f"우)1{i % 20:04d} 갤힘 주덜구 중앙로 {i % 20 + 1}") for i in range(200)] + [(1000 + i, f"우)2{i % 20:04d} 갤힘 거촌구 중앙로 {i % 20 + 1}") for i in range(200)]
    rows += [(2000 + i, f"중앙로 {i % 20 + 1}") for i in range(20)]
    rec = address.parsed(spark.createDataFrame(rows, "id long, address string"), "id", "address")
    got = {(r.record_id_a, r.record_id_b): r.probability for r in address.building_pairs(rec).collect()}
    assert all(p < 0.5 for (a, b), p in got.items() if a < 1000 <= b < 2000) and all(p > 0.5 for (a, b), p in got.items() if b < 1000 or 1000 <= a and b < 2000)
    assert {tuple(r) for r in address.same_building(rec).collect()} == {k for k, p in got.items() if p >= 0.5}


def test_edit_distance():
    assert [address.edit_distance(a, b) for a, b in (("", ""), ("ab", "ba"), ("abc", "abd"), ("abc", "xyz"), ("a", "abcdef"))] == [0, 1, 1, 3, 4]


def exact_marginals(pairs, more):
    """By summing over all sets of pairs: a right record in one pair at most, a left one weighs more ** (n - 1)."""
    total, by = 0.0, {p[:2]: 0.0 for p in pairs}
    for chosen in itertools.product((0, 1), repeat=len(pairs)):
        mine = [p for p, c in zip(pairs, chosen) if c]
        if max(Counter(p[1] for p in mine).values(), default=0) > 1:
            continue
        w = float(np.exp(sum(p[2] for p in mine))) * float(np.prod([more ** (n - 1) for n in Counter(p[0] for p in mine).values()]))
        total += w
        for p in mine:
            by[p[:2]] += w
    return {k: v / total for k, v in by.items()}


def test_propagation_on_trees_is_exact_and_settles_on_loops(spark):
    schema = "left_id long, right_id long, log_odds double"
    tree = [(1, 10, 2.0), (2, 10, 1.0), (2, 11, 0.5), (2, 12, 0.3), (3, 12, -1.0)]
    told, settled = entities.propagate(spark.createDataFrame(tree, schema), left_more=0.4, tolerance=1e-6)
    want = exact_marginals(tree, 0.4)
    assert settled.rounds > 2 and settled.largest_change <= 1e-6
    assert all(abs(r.probability - want[r.left_id, r.right_id]) < 1e-4 for r in told.collect())
    loop = [(1, 10, 4.0), (2, 10, 2.0), (2, 11, 1.5), (1, 11, 1.0), (3, 12, -3.0)]
    told, _ = entities.propagate(spark.createDataFrame(loop, schema), left_more=0.4)
    got = {(r.left_id, r.right_id): r.probability for r in told.collect()}
    assert got[1, 10] > 0.8 and got[2, 11] > got[2, 10] and got[2, 11] > got[1, 11]
    with pytest.raises(RuntimeError, match="still move"):
        entities.propagate(spark.createDataFrame(loop, schema), rounds=2, tolerance=0.0)


def test_names():
    assert entities.compact("(주)달빛 모텔 (본관) 정문") == entities.compact("달빛모텔") == "달빛모텔"
    assert entities.branch_of("은하마루게스트하우스 툰고역점") == "툰고역점" and entities.branch_of("휴게음식점") is None
    assert entities.similarity("팅잴초록어린이집", "어린이집팅잴초록") > 0.7 > entities.similarity("공중화장실", "솔향중중공중화장실")


def test_matching(spark):
    schema = "record_id long, names array<string>, branch string, buildings array<string>, road string, district string, metres double, category string"
    left = [(i, [f"가나{chr(0xAC00 + 37 * i)}{chr(0xB098 + 41 * i)}식당"], None, [f"길:{i}"], "길", "구", 10.0 * i, "R") for i in range(60)]
    right = [(100 + i, [f"가나{chr(0xAC00 + 37 * i)}{chr(0xB098 + 41 * i)}식당"], None, [f"길:{i}"], "길", "구", 10.0 * i + 0.3, "R") for i in range(0, 60, 2)]
    right += [(300, ["전혀다른병원"], None, ["길:3"], "길", "구", 400.0, "H"), (301, [], None, [], None, None, None, None)]
    left, right = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = entities.decide(entities.match(left, right)[0])
    assert {(r.left_id, r.right_id) for r in got.collect()} == {(i, 100 + i) for i in range(0, 60, 2)}
    assert entities.decide(entities.match(left.limit(0), right)[0]).count() == 0


def test_candidates_equal_brute_force(spark):
    """Every two alike names of which one has no building, and every two records of a building, but for far rivals of one class (unlike names in a building being one)."""
    rnd = random.Random(8)
    schema = "record_id long, names array<string>, branch string, buildings array<string>, road string, district string, metres double, category string"
    stems = ["".join(rnd.choice("가나다라마바사아자차카타파하") for _ in range(4)) for _ in range(60)]
    name = lambda i: stems[i % 60] + ("화장실" if i % 3 else "")
    metres = lambda: None if rnd.random() < 0.2 else round(rnd.random() * 90, 1)
    left = [(i, [name(i)] if i % 4 else ["공중화장실"], None, [f"길:{i % 50}"] if i % 5 else [], None, "구", metres(), "R") for i in range(240)]
    right = [(1000 + i, [name(i)] if i % 6 else ["공중화장실"], None, [f"길:{i % 50}"] if i % 3 else [], None, "구", metres(), "R") for i in range(120)]
    df = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = {tuple(r) for r in entities.candidate_pairs(*df).collect()}
    n = len({x[1][0] for x in left + right})
    pieces = lambda s: {s[i : i + 2] for i in range(len(s) - 1)}
    names = {x[1][0] for x in left + right}
    df_ = Counter(p for x in names for p in pieces(x))
    weight = lambda ps: sum(math.log1p(n / df_[p]) for p in ps)
    alike = lambda a, b: weight(pieces(a) & pieces(b)) >= 0.5 * max(weight(pieces(a)), weight(pieces(b))) - 1e-9
    near = lambda x, y: x[6] is not None and y[6] is not None and abs(x[6] - y[6]) <= 12
    for y in right:
        for x in left:
            one_house, open_ = bool(set(x[3]) & set(y[3])), not x[3] or not y[3]
            if not one_house and not (open_ and alike(x[1][0], y[1][0])):
                assert (x[0], y[0]) not in got
                continue
            rivals = [z for z in left if (z[1] == x[1] or not alike(x[1][0], y[1][0])) and (set(z[3]) & set(y[3]) if one_house else not y[3] or not z[3])]
            if len(rivals) == 1 or near(x, y):
                assert (x[0], y[0]) in got
            elif (x[0], y[0]) not in got:  # far, or one of several without distance
                assert len(rivals) > 1 and (x[6] is None or y[6] is None or not near(x, y))


def test_large_classes_keep_far_and_missing_pairs(spark):
    """Lefts of one name and kind that are far from the right one, or without a distance, are candidates like near ones."""
    schema = "record_id long, names array<string>, branch string, buildings array<string>, road string, district string, metres double, category string"
    left = spark.createDataFrame([(i, ["공중화장실"], None, h, None, "구", m, "T") for i, (h, m) in enumerate([([], 5.0), ([], 500.0), ([], None), ([], None), (["길:1"], 900.0), (["길:1"], None)])], schema)
    right = spark.createDataFrame([(10, ["공중화장실"], None, [], None, "구", 5.0, "T"), (11, ["공중화장실"], None, ["길:1"], None, "구", None, "T")], schema)
    got = {tuple(r) for r in entities.candidate_pairs(left, right).collect()}
    assert got == {(i, r) for i in range(6) for r in (10, 11)}


def test_disguise_is_undone():
    assert abuse.normalize("너 같은 쓰 레 기, 멍*청이야!! 씨발발발발") == ["너", "같은", "쓰레기", "멍청이야", "씨발"]
    assert abuse.normalize("You dumb@55, b@5t@rd!") == ["you", "dumbass", "bastard"]
    assert abuse.normalize("You are trash!") == ["you", "are", "trash"] and abuse.normalize("Go 2 room101!!") == ["go", "0", "room", "0"]
    assert abuse.normalize("g0 t0 h3ll, k155 it") == ["go", "to", "hell", "kiss", "it"]
    assert abuse.split_sentences("<b class='x'>안녕</b> <씨발 꺼져> a<br/>c") == [" 안녕  <씨발 꺼져> a c"]
    assert len(abuse.word_buckets("motherfuckering!")) == len(abuse.word_buckets("a" * abuse.WHOLE_LATIN)) == abuse.PIECES
    enc = abuse.Encoder()
    assert (enc(enc.windows(["motherfuckers"])) > 0).sum() == 1 and set(abuse.word_buckets("motherfuckers")) <= set(enc.table[1].tolist())
    long = "가나다라마바사아자차" * 30
    assert set("".join(abuse.normalize(long))) == set(long)


def test_classifier_finds_planted_insults():
    rnd = np.random.default_rng(1)
    plain = ["The ramp is steep today.", "경사로가 조금 가파르다.", "버스가 늦게 왔다.", "The lift works fine now.", "고양이 새끼가 살고 있다.", "점자블록이 끊겨 있다."]
    rude = ["너는 정말 멍청이 쓰레기야.", "꺼져라 이 쓰레기 놈들.", "You are a worthless idiot.", "Shut up you idiot moron."]
    rows = []
    for i in range(400):
        body = list(rnd.choice(plain, 4))
        bad = i % 8 == 0
        if bad:
            body[int(rnd.integers(4))] = str(rnd.choice(rude))
        rows.append((i, " ".join(body), "ko" if i % 2 else None, float(bad) if i % 37 else 1.0 - float(bad)))
    model = abuse.train(rows)
    texts = [None, "", "  ", "The ramp is steep today. You are a worthless idiot.", "고양이 새끼가 살고 있다. 버스가 늦게 왔다.", "버스가 늦게 왔다. 꺼져라 이 쓰 레 기 놈들."]
    s = model.score(texts)
    assert s[:3].tolist() == [0, 0, 0] and s[3] > 0.5 > s[4] and s[5] > 0.5
    assert abuse.train([(1, "a", None, 0.0)]).score(["x"])[0] == 0


def test_scored_dataframe(spark):
    model = abuse.Model(None, {"": 1.1})
    df = spark.createDataFrame([(1, None, None, None, 1), (2, "hello", "EN", "s", 2)], "doc_id long, text string, lang string, source string, score int")
    assert {tuple(r) for r in abuse.scored(df, model).collect()} == {(1, None, "ko", 0.0, False), (2, "s", "en", 0.0, False)}
