"""Plan compilers that fuse many rules into few scans."""
