"""The fixed prompt texts and template markers, pinned: queries and oracles share them, so neither would notice a change."""

import hashlib

import pytest

from tessera.operators import prompts

DIGESTS = {
    "BOXED_ANSWER_SYSTEM_PROMPT": "6ccdf856cf4ea769baad5f6a707970ff",
    "CHOICE_QUERY_TEMPLATE": "1f97bdc50ac14529c55d6b07dda62b76",
    "DEFAULT_EOS": "f00ac5d3805d9ac73685eb3e61cdac7e",
    "EVAL_TASKS": "6207870bec0237c7111a66936af3a284",
    "FAMILY_MARKERS": "1f2a304a7d4c4644aa1c53a44767240e",
    "INSTRUCT_TEXT": "f9f76b622851fda490b5cfc784698ccf",
    "INSTRUCT_TEXT_PLACEHOLDER": "5fa145b10d557f3dd54c54929f381034",
    "LENGTH_HINT": "c32d8108a769045419e22814716f917f",
    "MATH_QUERY_TEMPLATE": "1ccb7eee7bf55bf6dcf99029e773dd52",
    "REASONING_FORMAT_SYSTEM_PROMPT": "966016ee2b37b08dd023526dd7b4bec1",
    "R_ASSISTANT": "51c88c536d64c506efe9d9fe64e4e374",
    "R_CALLS_BEGIN": "837661dc5607d771906f5a7d144481f2",
    "R_CALLS_END": "e5c65ba78d6db958dc583193de2c8bd4",
    "R_CALL_BEGIN": "a33fc9523b28228b5c6e8ed1921c17c4",
    "R_CALL_END": "162e28c00894e2515b07508385d4b233",
    "R_EOS": "65c8281e14c00686626682e32450602a",
    "R_OUTPUTS_BEGIN": "b888ced9344dd01868a7662fa40e22a8",
    "R_OUTPUTS_END": "669452273ee87f73d10f0f766a409050",
    "R_OUTPUT_BEGIN": "bb16ac6cadf2d7a62a0cd9356916c6a4",
    "R_OUTPUT_END": "627f9206b8679386619cd441f26bd49f",
    "R_SEP": "d08138b3ceb2d954072cd2cf278adf88",
    "R_USER": "9f1db0a40b555b763e22285ffcdbbe95",
    "SFT_ASSISTANT": "bf9ad449d2f75144e2b481b0deb8bdff",
    "SIMPLE_CHAT_GENERATION": "7021a9edb1e3c791a131af8a4bdca63f",
    "SIMPLE_CHAT_MESSAGE": "ab07f4527d0b0563f27c695cec86896b",
    "TUNING_SYSTEM_PROMPT": "a01d28516a85f6514b707b46d0642117",
}


@pytest.mark.parametrize("name", sorted(DIGESTS))
def test_fixed_text(name):
    value = getattr(prompts, name)
    text = value if isinstance(value, str) else repr(sorted(value.items()))
    assert hashlib.md5(text.encode()).hexdigest() == DIGESTS[name]
