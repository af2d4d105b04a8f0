"""No streaming operators: every input of the analysed workload is a finite table."""
