"""From raw documents to token shards: the stages are in ``tidegrid.llm.corpus``."""

from tidegrid.llm.corpus import ORACLE_SQL, STAGES, decontaminate, mix, near_dedup, quality, run, tokens

__all__ = ["ORACLE_SQL", "STAGES", "decontaminate", "mix", "near_dedup", "quality", "run", "tokens"]
