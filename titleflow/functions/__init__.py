"""Column -> Column building blocks. Everything here is a native Spark
expression (whole-stage codegen / higher-order functions); no Python UDF."""

from titleflow.functions.arrays import (argmax, cross_entropy, fit_length,
                                        log_softmax, multiply, softmax)
from titleflow.functions.text import (WHITESPACE_CLASS, basic_english_rules,
                                      sentences_treebank, tokenize_basic,
                                      tokenize_treebank, tokenize_words, treebank_rules)

__all__ = [
    "argmax", "cross_entropy", "fit_length", "log_softmax", "multiply",
    "softmax", "WHITESPACE_CLASS", "basic_english_rules", "tokenize_basic",
    "tokenize_words", "tokenize_treebank", "sentences_treebank", "treebank_rules",
]
