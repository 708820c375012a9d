"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from .op1_sentencepiece import op1_sentencepiece
from .op2_brown import op2_brown
from .op3_decision_list import op3_decision_list
from .op4_reputation import SQL as OP4_SQL
from .op4_reputation import op4_reputation
from .op5_toxicity import op5_toxicity
from .op6_paragraphs import op6_paragraphs
from .op7_licences import SQL as OP7_SQL
from .op7_licences import op7_licences
from .op8_simhash import op8_simhash
from .op9_chat import SQL as OP9_SQL
from .op9_chat import op9_chat
from .op10_decontaminate import SQL as OP10_SQL
from .op10_decontaminate import op10_decontaminate
from .op11_setm import SQL as OP11_SQL
from .op11_setm import op11_setm
from .op12_merkle import SQL as OP12_SQL
from .op12_merkle import op12_merkle
from .op13_threshold import SQL as OP13_SQL
from .op13_threshold import op13_threshold

QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_brown, op3_decision_list, op4_reputation, op5_toxicity, op6_paragraphs, op7_licences, op8_simhash, op9_chat, op10_decontaminate, op11_setm,
                                  op12_merkle, op13_threshold)}
ORACLE_SQL = {"op4_reputation": OP4_SQL, "op7_licences": OP7_SQL, "op9_chat": OP9_SQL, "op10_decontaminate": OP10_SQL,
              "op11_setm": OP11_SQL, "op12_merkle": OP12_SQL, "op13_threshold": OP13_SQL}
