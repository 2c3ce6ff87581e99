"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from threadloom.llm import bpe, chat, decontaminate, fingerprint, minhash, quality, sharding, substring, toxicity, warc


def queries() -> dict:
    return {
        "op1_minhash_dedup": minhash.op1_minhash_dedup,
        "op2_fingerprints": fingerprint.op2_fingerprints,
        "op3_decontaminate": decontaminate.op3_decontaminate,
        "op4_sharding": sharding.op4_sharding,
        "op5_warc": warc.op5_warc,
        "op6_byte_bpe": bpe.op6_byte_bpe,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_substring_dedup": substring.op8_substring_dedup,
        "op9_quality": quality.op9_quality,
        "op10_chat_formatting": chat.op10_chat_formatting,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": minhash.OP1_SQL,
        "op2_fingerprints": fingerprint.OP2_SQL,
        "op4_sharding": sharding.OP4_SQL,
        "op5_warc": warc.OP5_SQL,
        "op8_substring_dedup": substring.OP8_SQL,
        "op10_chat_formatting": chat.OP10_SQL,
    }
