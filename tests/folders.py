"""Where the small test tables lie."""

SMALL = "/root/testdata/sf0.001"
