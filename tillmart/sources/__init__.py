"""Where data comes from: landing folders, CSV, workbooks, the file ledger."""
