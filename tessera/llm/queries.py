"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tessera.llm import chats, merkle, phrases, quality, secrets
from tessera.llm.bpe import op6_bpe
from tessera.llm.chats import op3_chats
from tessera.llm.decontamination import op8_decontamination
from tessera.llm.language import op11_language
from tessera.llm.lm import op5_lm
from tessera.llm.merkle import op13_merkle
from tessera.llm.phrases import op12_phrases
from tessera.llm.pii import op9_personal
from tessera.llm.quality import op4_quality
from tessera.llm.resharding import op2_resharding
from tessera.llm.secrets import op7_secrets
from tessera.llm.simhash import op10_simhash
from tessera.llm.token_files import op1_token_files

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_resharding": op2_resharding,
    "op3_chats": op3_chats,
    "op4_quality": op4_quality,
    "op5_lm": op5_lm,
    "op6_bpe": op6_bpe,
    "op7_secrets": op7_secrets,
    "op8_decontamination": op8_decontamination,
    "op9_personal": op9_personal,
    "op10_simhash": op10_simhash,
    "op11_language": op11_language,
    "op12_phrases": op12_phrases,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op3_chats": chats.ORACLE,
    "op4_quality": quality.oracle(),
    "op7_secrets": secrets.oracle(),
    "op12_phrases": phrases.oracle(),
    "op13_merkle": merkle.oracle(),
}
