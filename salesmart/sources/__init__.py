"""Sources: declared-schema readers for order-line CSV files, source tables
at rest and literal rows (``files``), and the test-data adapter
(``testdata``) mapping the TPC-H-like tables onto the source tables."""
