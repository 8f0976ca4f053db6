"""Training-data operators: chat windows, BPE, near duplicates, quality, line and
substring dedup, licences, personal data, decontamination, language id."""
