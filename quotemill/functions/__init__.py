"""Column expressions and field codecs."""
