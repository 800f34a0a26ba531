"""Column-name operators on name lists."""

from __future__ import annotations

import re

from fieldbook.functions import clean_name_list, names_without, replace_in_name, snake_name
from fieldbook.operators.rollup import GROUP_LABELS, LAYOUT_PATTERNS


def test_snake_name():
    assert snake_name("Q7. Name of Participant (Main)") == "q7_name_of_participant_main"
    assert snake_name("Member Phone Number") == "member_phone_number"
    assert snake_name("_id") == "id"
    assert snake_name("camelCaseName") == "camel_case_name"
    assert snake_name("Share %") == "share_percent"
    assert snake_name("1st visit") == "x1st_visit"
    assert snake_name("Café") == "cafe"


def test_other_scripts_stay_readable_and_distinct():
    assert snake_name("ಹೆಸರು") == "hesaru"  # Kannada: name
    assert snake_name("ವಯಸ್ಸು") == "vayassu"  # age
    assert snake_name("नाम") == "naama"  # Hindi: name; the last consonant keeps its vowel
    assert snake_name("नमस्ते दुनिया") == "namaste_duniyaa"
    assert snake_name("தமிழ் பெயர்") == "tamilll_peyar"  # Tamil
    assert snake_name("Имя участника") == "imya_uchastnika"  # Russian
    assert snake_name("Ὄνομα") == "omicronnuomicronmualpha"  # Greek letters by their names
    assert snake_name("이름") == "ireum"  # Korean syllables
    assert snake_name("Größe (m²)") == "grosse_m2" and snake_name("Łódź") == "lodz"
    assert snake_name("फ़ोन नंबर") == "phona_nambara"  # a dot below changes no vowel
    names = ["ಹೆಸರು", "ವಯಸ್ಸು", "ಊರು", "ಫೋನ್ ಸಂಖ್ಯೆ", "नाम", "आयु", "फ़ोन नंबर", "姓名", "年齢", "الاسم", "العمر"]
    clean = clean_name_list(names)
    assert len({c.rstrip("_0123456789") for c in clean[:7]}) == 7 and len(set(clean)) == len(names)
    assert all(re.fullmatch("[a-z][a-z0-9_]*", c) for c in clean)


def test_an_apostrophe_inside_a_word_is_removed():
    assert snake_name("Participant's Name") == snake_name("Participant’s Name") == "participants_name"
    assert snake_name('The "main" shop') == "the_main_shop"


def test_clean_name_list_is_unique():
    assert clean_name_list(["A b", "a_b", "a-b", "x"]) == ["a_b", "a_b_2", "a_b_3", "x"]


def test_names_without_is_case_insensitive():
    names = ["intro_HEADER", "consent_note", "gps_info", "member_id", "group_gn69x50_total"]
    assert names_without(names, LAYOUT_PATTERNS) == ["member_id", "group_gn69x50_total"]


def test_replace_in_name_applies_every_code():
    assert replace_in_name("group_gn69x50_total", GROUP_LABELS) == "b1_rev_total"
    assert replace_in_name("group_xp4ro84/q1", GROUP_LABELS) == "b3_exp/q1"
    assert replace_in_name("member_id", GROUP_LABELS) == "member_id"


def test_tidy_baseline_projection(spark, fx_small):
    from fieldbook.operators.rollup import tidy_baseline

    cols = tidy_baseline(fx_small.baseline_raw).columns
    assert "b1_rev_total" in cols and "b3_exp_total" in cols
    assert not any(p in c for c in cols for p in LAYOUT_PATTERNS)
