"""Fixed formats of the records that enter and leave the jobs."""

# One line of the labelled corpus; other fields of the line are ignored.
RAW = "claim string, label string, _corrupt_record string"

# A cleaned claim: label 0 is supported, 1 is anything else.
CLAIM = "claim string, entity_redacted_claim string, label int"

# A scored claim as it is read back from the topic: everything is text first.
SCORED = "claim string, entity_redacted_claim string, label string, predicted_label string"
