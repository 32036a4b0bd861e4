"""Where the public tokenizer files are; the path is a parameter of the operators."""

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as a table of ranks.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
