"""The three sample metric inputs (20 lines each), as literal text.

Order key = line position: the last line is the newest record.
"""

# --- fixed values: sample metric records (file order)
TEST_LINES = """\
0.309,\t0.206,\t55217371\t, 383372658,\t0.316,\t0.076,\t0.592
0.329,\t0.238,\t55218198\t, 383374831,\t0.316,\t0.076,\t0.592
0.388,\t0.298,\t55218477\t, 383376632,\t0.316,\t0.076,\t0.592
0.239,\t0.154,\t55218621\t, 383377935,\t0.316,\t0.076,\t0.592
0.338,\t0.184,\t55218957\t, 383467811,\t0.316,\t0.076,\t0.592
0.309,\t0.228,\t55219236\t, 383468837,\t0.316,\t0.076,\t0.592
0.248,\t0.141,\t55221074\t, 383469771,\t0.314,\t0.076,\t0.592
0.315,\t0.228,\t55221256\t, 383471347,\t0.314,\t0.076,\t0.592
0.267,\t0.184,\t55221422\t, 383472404,\t0.314,\t0.076,\t0.592
0.403,\t0.235,\t55221754\t, 383572994,\t0.314,\t0.076,\t0.592
0.309,\t0.206,\t55217371\t, 383372658,\t0.316,\t0.076,\t0.592
0.329,\t0.238,\t55218198\t, 383374831,\t0.316,\t0.076,\t0.592
0.388,\t0.298,\t55218477\t, 383376632,\t0.316,\t0.076,\t0.592
0.239,\t0.154,\t55218621\t, 383377935,\t0.316,\t0.076,\t0.592
0.338,\t0.184,\t55218957\t, 383467811,\t0.315,\t0.076,\t0.592
0.309,\t0.228,\t55219236\t, 383468837,\t0.315,\t0.076,\t0.592
0.248,\t0.141,\t55221074\t, 383469771,\t0.315,\t0.076,\t0.592
0.315,\t0.228,\t55221256\t, 383471347,\t0.315,\t0.076,\t0.592
0.267,\t0.184,\t55221422\t, 383472404,\t0.315,\t0.076,\t0.592
0.403,\t0.235,\t55221754\t, 383572994,\t0.315,\t0.076,\t0.592""".splitlines()

TEST2_COLUMN = [52.0, 47.0, 53.0, 49.3, 50.1, 47.0, 51.0, 50.1, 51.2, 50.5,
                49.6, 47.6, 49.9, 51.3, 47.8, 51.2, 52.6, 52.4, 53.6, 52.1]

TEST3_LABEL = "2018-08-29T05:40:20.927Z"
# --- end of fixed values

TEST2_LINES = [",".join([repr(v)] * 7) for v in TEST2_COLUMN]
TEST3_LINES = [f"{TEST3_LABEL},{line}" for line in TEST_LINES]
