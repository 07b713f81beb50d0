"""Training-data operators: scoring, sharding, near-duplicates, language,
decontamination, packing, chat formatting, token counts, token files and
quality rules.  Nothing outside this subpackage imports it."""
